import random

import brute
import pytest

from gridtide.llm import substrings


def _found(docs, **settings):
    rows = substrings.without_repeats(docs, **settings).collect()
    return {row.doc_id: (row.n_words, row.n_removed, row.kept) for row in rows}


def _texts(odd_texts, small_texts):
    words = small_texts[0].split()
    shared = " ".join(words[:30])
    more = [shared, f"a {shared} b {shared}", " ".join(words[:19]), " ".join(words[5:25]), "r " * 100, "x y " * 60]
    return dict(enumerate([*odd_texts, *more])) | {100 + i: text for i, text in small_texts.items()}


def test_equals_brute_force(docs_of, odd_texts, small_texts):
    texts = _texts(odd_texts, small_texts)
    items = list(texts.items())
    random.Random(1).shuffle(items)
    assert _found(docs_of(items)) == brute.kept_words(texts)


@pytest.mark.parametrize(("window", "first"), [(3, 5), (7, 2)])
def test_other_lengths(docs_of, odd_texts, window, first):
    rng = random.Random(2)
    texts = dict(enumerate([*odd_texts, *(" ".join(rng.choice("ab") for _ in range(40)) for _ in range(6))]))
    assert _found(docs_of(texts.items()), window=window, first=first) == brute.kept_words(texts, window)


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    text = " ".join(map(str, range(25)))
    rows = substrings.without_repeats(docs_of([(2, text), (2, text), (None, text), (1, "z " + text)])).collect()
    assert sorted((row.doc_id or 0, row.n_removed) for row in rows) == [(0, 0), (1, 25), (2, 25), (2, 25)]
    assert _found(docs_of([])) == {}


def test_long_words_of_the_thue_morse_order_differ(docs_of):
    """A polynomial hash modulo a power of two cannot tell these two words apart."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    words = ["".join("ab"[bit ^ flip] for bit in bits) for flip in (0, 1)]
    rest = " ".join(f"w{i}" for i in range(19))
    done = substrings.without_repeats(docs_of([f"{word} {rest}" for word in words] + [f"{words[0]} {rest}"]))
    assert sorted((row.doc_id, row.n_removed) for row in done.collect()) == [(0, 0), (1, 0), (2, 20)]
