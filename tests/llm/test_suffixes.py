import random

import brute
import numpy as np
import pytest

from gridtide.llm import suffixes


def _found(docs, **settings):
    rows = suffixes.without_repeats(docs, **settings).collect()
    return {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) for row in rows}


def _texts(odd_texts, small_texts):
    shared = small_texts[0][:400]
    more = [shared, f"a {shared} b {shared}", shared[:199], shared[3:203], "é" * 150, "ab" * 300, f"é{shared[50:300]}ü"]
    return dict(enumerate([*odd_texts, *more])) | {100 + i: text for i, text in small_texts.items()}


@pytest.mark.parametrize("most", [4000, 2])
def test_equals_brute_force(docs_of, odd_texts, small_texts, most):
    texts = _texts(odd_texts, small_texts)
    items = list(texts.items())
    random.Random(1).shuffle(items)
    assert _found(docs_of(items), most=most) == brute.kept_bytes(texts)


def test_short_strings_of_few_letters(docs_of):
    rng = random.Random(4)
    texts = {i: "".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for i in range(60)}
    assert _found(docs_of(texts.items()), length=8, anchor=3) == brute.kept_bytes(texts, 8)


def test_anchor_of_fifty_thousand_places(spark, docs_of, monkeypatch):
    """A passage in 50,000 texts: all of it goes, in a few classes, with at most two rows of a string and level."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh") for _ in range(30))
    texts = {i: f"{i:05d}{passage[: 24 + i % 7]}{i * 7919 % 100_000:05d}" for i in range(50_000)}
    made, write = [], suffixes.stored

    def noted(df, name):
        table = write(df, name)
        made.append((name, table.count()))
        return table

    monkeypatch.setattr(suffixes, "stored", noted)
    assert _found(docs_of(texts.items()), length=20, anchor=5, most=500) == brute.kept_bytes(texts, 20)
    strings = sum(count for name, count in made if name == "contexts")
    assert all(count <= 2 * strings for name, count in made if name == "pieces")
    assert 1 < sum(name == "pieces" and count > 0 for name, count in made) <= 4


def test_equal_strings_are_cut_out_once(docs_of, monkeypatch):
    """Near copies: bytes move once for each different string of an anchor, not once for each text that holds it."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh") for _ in range(300))
    texts = {i: f"{i:04d}{passage}{i * 7919 % 10_000:04d}" for i in range(600)}
    made, write = [], suffixes.stored

    def noted(df, name):
        table = write(df, name)
        if "data" in table.columns:
            made.append((table.count(), table.select("hash", "lead", "data").distinct().count()))
        return table

    monkeypatch.setattr(suffixes, "stored", noted)
    assert _found(docs_of(texts.items()), length=20, anchor=5) == brute.kept_bytes(texts, 20)
    assert made and all(rows == different for rows, different in made)


def test_columns_equal_comparison_of_all_pairs():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 20))) for _ in range(60)]
    leads = np.array([rng.randint(0, 2) for _ in strings])
    found = suffixes.repeated_columns(strings, leads, 6)
    shift = leads.max() - leads
    for i, string in enumerate(strings):
        for column in range(found.shape[1]):
            at = column - shift[i]
            piece = string[at : at + 6] if at >= 0 else b""
            expected = len(piece) == 6 and any(
                j != i and column >= shift[j] and other[column - shift[j] : column - shift[j] + 6] == piece
                for j, other in enumerate(strings)
            )
            assert found[i, column] == expected


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    text = "".join(map(chr, range(40, 120))) * 4
    rows = suffixes.without_repeats(docs_of([(2, text[:250]), (2, text[:250]), (None, "q" + text[5:260]), (1, None)])).collect()
    assert sorted((row.doc_id or 0, row.n_removed, row.n_spans) for row in rows) == [(0, 245, 1), (1, 0, 0), (2, 250, 1), (2, 250, 1)]
    assert _found(docs_of([])) == {}
