import math
import random
from collections import Counter, defaultdict

import brute
import regex

from gridtide.llm import privacy

TRICKY = [
    "a@b.c_d@e.f g@h i@j.k. ..@x.y-z.w", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 1.2.3", "999.1.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 1--23", "+1 (234) 567-8901 +49 30 1234 +12 3456789012345678",
    "+4111111111111111", "é +33 1 23 45 67 89 ñ x@y.zz", "1" * 40, "+" * 30 + "1 2", "a" * 5000 + "@" + "b" * 50 + ".c",
]


def _rows(docs):
    return privacy.personal_spans(docs).select("doc_id", privacy.listed("base").alias("base"), privacy.listed("spans").alias("spans")).collect()


def _expected(text):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in brute.personal(text))


def test_base_spans_equal_brute_force(docs_of, odd_texts, small_texts):
    texts = dict(enumerate([*odd_texts, *TRICKY])) | {100 + i: text for i, text in small_texts.items()}
    found = {row.doc_id: row.base for row in _rows(docs_of(texts.items()))}
    assert found == {i: _expected(text) for i, text in texts.items()}


def _corpus():
    telling = [f"filler number {i} says write Zyxwv to boss@corp.example about this matter {i}" for i in range(6)]
    plain = [f"filler number {i} says write nothing about this matter {i}" for i in range(60)]
    return telling + plain


def test_only_revealing_words_are_added(docs_of):
    rows = {row.doc_id: row for row in _rows(docs_of(_corpus()))}
    text = _corpus()[0]
    start = text.index("Zyxwv")
    assert f"remove:{start}:{start + 5}" in rows[0].spans.split(",")
    assert "matter" not in {text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows[0].spans.split(",")}
    assert all(rows[i].spans == "" for i in range(6, 66))


def test_copies_count_as_one_text(docs_of):
    rows = _rows(docs_of(["write Zyxwv to boss@corp.example"] * 9 + ["plain text"] * 9))
    assert {row.spans for row in rows} == {"email:15:32", ""}


def test_three_texts_are_enough_and_copies_do_not_change_counts(docs_of):
    telling = [f"filler {i} write Zyxwv to boss@corp.example about {i}" for i in range(3)]
    stray = ["a letter from Zyxwv about nothing else"]
    plain = [f"filler {i} write nothing about {i}" for i in range(400)]
    once = _rows(docs_of(telling + stray + plain))
    assert all("remove:" in r.spans for r in once if r.base)
    copied = _rows(docs_of(telling + stray * 300 + plain))
    assert {r.spans for r in copied if r.base} == {r.spans for r in once if r.base}


def _filler(seed, size=25):
    words = "nothing of note was said about the matter that day for all who came and went their own way as before".split()
    return " ".join(random.Random(seed).choices(words, k=size))


def test_words_anywhere_in_a_text_reveal_and_are_marked_everywhere(docs_of):
    # Each text has words of its own order: texts that copy each other would count as one.
    gaps = [_filler(i) for i in range(305)]
    telling = [f"Zyxwv, Li and Ann met again. {gaps[i]} Then came boss@corp.example {i}" for i in range(4)]
    lone = [f"again Zyxwv and Li. {gaps[4]} no value here, é Ann"]
    plain = [f"no value here and met again then came {gaps[i]} {i}" for i in range(5, 305)]
    texts = [*telling, *lone, *plain]
    rows = {row.doc_id: row.spans for row in _rows(docs_of(texts))}
    for i in range(5):
        starts = sorted((texts[i].index(name), len(name)) for name in ("Zyxwv", "Li", "Ann"))
        found = [tuple(map(int, span.split(":")[1:])) for span in rows[i].split(",") if span.startswith(("remove", "term"))]
        assert found == [(start, start + size) for start, size in starts]
    assert all(rows[i] == "" for i in range(5, 305))


def _disclosing(texts, min_texts=3):
    """Terms and their kinds, from all pairs of distinct texts that do not depend on each other."""
    texts = sorted(set(filter(None, texts)) | {""})
    words, holders = defaultdict(set), defaultdict(set)
    for place, text in enumerate(texts):
        for word in regex.findall(privacy.TERM, text):
            words[word if len(word) < 3 else word.lower()].add(place)
        for kind, value in {(kind, text[start:end].lower()) for start, _, end, kind in brute.personal(text)}:
            holders[kind, value].add(place)
            if kind == "email":
                holders["domain", value.rpartition("@")[2]].add(place)
    total, best = len(texts), Counter()
    for held in holders.values():
        for word, there in words.items():
            a, b, both = len(held), len(there), len(held & there)
            if a >= min_texts and both >= min_texts and a < total:
                cells = [(both, a * b), (a - both, a * (total - b)), (b - both, b * (total - a)), (total - a - b + both, (total - a) * (total - b))]
                g = 2 * sum(n * math.log(n * total / e) for n, e in cells if n)
                if g >= privacy.LEAST_G:
                    best[word] = max(best[word], math.log(total * both / (a * b)) / math.log(total / a))
    return {word: "remove" if share >= 0.9 else "term" for word, share in best.items() if share >= 0.7}


def test_added_spans_equal_brute_force(docs_of):
    rng, names = random.Random(4), [f"{a}{b}son" for a in ("An", "Be", "Ca", "Do") for b in ("ka", "lu", "mo", "né")]
    texts = []
    for i in range(400):
        parts = [_filler(1000 + i, 12)]
        person = rng.randrange(16)
        if rng.random() < 0.5:
            parts.append(rng.choice([names[person], "Jo", "the office"]))
            parts.append(rng.choice([f"p{person}@d{person % 3}.example", f"10.0.0.{person % 4}", "+49 30 1234567", "", ""]))
        rng.shuffle(parts)
        texts.append(" ".join([*parts, rng.choice(names), _filler(5000 + i, 8)]))
    texts += texts[:50] * 5 + [None, ""]
    kinds = _disclosing(texts)
    assert set(kinds.values()) == {"remove", "term"} or kinds
    expected = {}
    for i, text in enumerate(texts):
        base = brute.personal(text)
        spans = [(start, rank, end, kind) for start, rank, end, kind in base]
        for match in regex.finditer(privacy.TERM, text or ""):
            word = match.group() if len(match.group()) < 3 else match.group().lower()
            if word in kinds and not any(start < match.end() and match.start() < end for start, _, end, _ in base):
                spans.append((match.start(), 9, match.end(), kinds[word]))
        expected[i] = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
    assert {row.doc_id: row.spans for row in _rows(docs_of(texts))} == expected


def test_texts_that_copy_each_other_count_once(docs_of):
    base = _filler(1, 60).split()
    copies = []
    for i in range(12):
        words = list(base)
        words[3 * i] = f"other{i}"
        copies.append(" ".join([*words[:30], "Zyxwv writes to boss@corp.example", *words[30:]]))
    plain = [_filler(100 + i, 30) for i in range(300)]
    assert all(row.spans == brute_spans for row, brute_spans in ((r, _expected([*copies, *plain][r.doc_id])) for r in _rows(docs_of([*copies, *plain]))))


def test_many_matches_in_one_text(docs_of):
    text = "".join(f"né u{i}@h.example\n" for i in range(20_000))
    docs = docs_of([text, "plain"])
    row = next(row for row in _rows(docs) if row.doc_id == 0)
    assert row.base == _expected(text)
    out = {row.doc_id: row.text for row in privacy.sanitise(docs).collect()}
    assert out == {0: "né [EMAIL]\n" * 20_000, 1: "plain"}


def test_columns_named_like_those_inside(docs_of):
    from pyspark.sql import functions as F

    names = ("spans", "_id", "_hash", "_text", "base", "term", "_row_hash", "hits")
    docs = docs_of(["mail a@b.example", None]).withColumns({name: F.lit(name) for name in names})
    out = {row.doc_id: row for row in privacy.sanitise(docs).collect()}
    assert out[0].text == "mail [EMAIL]" and all(out[0][name] == name for name in names)
    assert privacy.sanitise(docs).columns == docs.columns


def test_overlapping_spans_and_far_places(spark):
    text = "ab" * 1500 + "é" + "cd" * 1500
    spans = [(0, 0, 3, "email"), (2, 1, 6, "ip"), (999, 0, 1001, "card"), (1000, 1, 1000, "ip"), (2999, 0, 3002, "remove"), (5990, 3, 6001, "phone")]
    schema = "text string, spans array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
    df = spark.createDataFrame([(text, spans), (text, []), (None, [])], schema)
    out, end = [], 0
    for start, _, stop, kind in spans:
        if start >= end:
            out += [text[end:start], "" if kind == "remove" else f"[{kind.upper()}]"]
        end = max(end, stop)
    got = [row[0] for row in df.select(privacy.sanitised(df["text"])).collect()]
    assert got == ["".join(out) + text[end:], text, None]


def test_sanitised_texts(docs_of):
    docs = docs_of([*_corpus(), None, "", "card 4111 1111 1111 1111 ip 10.0.0.1 +1 234 567 8901 end"])
    out = {row.doc_id: row for row in privacy.sanitise(docs).collect()}
    assert out[0].text == "filler number 0 says write  to [EMAIL] about this matter 0"
    assert (out[6].text, out[66].text, out[67].text) == (_corpus()[6], None, "")
    assert out[68].text == "card [CARD] ip [IP] [PHONE] end" and out[68].n_chars == len(out[68].text)
    assert privacy.sanitise(docs).columns == docs.columns


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = _rows(docs_of([(1, "x@y.zz"), (1, "x@y.zz"), (None, "x@y.zz"), (1, "no")]))
    assert sorted(((r.doc_id or 0), r.base) for r in rows) == [(0, "email:0:6"), (1, ""), (1, "email:0:6"), (1, "email:0:6")]
    assert _rows(docs_of([])) == []
