import re

import brute

from gridtide.llm import exact_dedup, quality_rules


def _verdicts(docs, trusted, **settings):
    return {row.doc_id: row for row in quality_rules.quality_rules(docs, trusted, **settings).collect()}


def test_base_counts_equal_brute_force(spark, docs_of, odd_texts, small_texts):
    texts = dict(enumerate(odd_texts)) | {100 + i: text for i, text in small_texts.items()}
    rows = _verdicts(docs_of(texts.items()), spark.createDataFrame([(100,)], "doc_id long"))
    for i, text in texts.items():
        assert {name: rows[i][name] for name in brute.rules("")} == brute.rules(text)
        assert not (rows[i].base_failed and rows[i].kept)


def _mixture():
    good = [" ".join(f"word{(7 * i + j * j) % 97}" for j in range(80)) for i in range(60)]
    bad = [" ".join(f"word{(5 * i + j * j) % 89}@@@ ~~" for j in range(60)) for i in range(20)]
    return good, bad


def test_ratio_rejects_what_the_trusted_lack(spark, docs_of):
    good, bad = _mixture()
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    rows = _verdicts(docs_of(good + bad), trusted)
    assert all(rows[i].log_ratio > -0.25 for i in range(60))
    assert not any(rows[i].kept for i in range(60, 80))
    # The same verdicts from a table four times as long: the counts cover all of it.
    again = _verdicts(docs_of([*good, *bad, *good, *good, *good, *bad, *bad, *bad]), trusted)
    assert all(again[i].kept == rows[i].kept for i in range(80))


def test_ratio_equals_plain_sums(spark, docs_of):
    """Scores from the definition, with the buckets that Spark's hash gives."""
    import math
    from collections import Counter

    from pyspark.sql import functions as F

    good, bad = _mixture()
    texts = good + bad
    trusted = set(range(0, 60, 2))
    grams = {}
    for i, text in enumerate(texts):
        found = re.findall(r"[a-z]+|[^\sa-z]+", text)
        grams[i] = [(token,) for token in found] + list(zip(found, found[1:]))
    distinct = sorted({gram for part in grams.values() for gram in part})
    frame = spark.createDataFrame([(g[0], g[1] if len(g) > 1 else None) for g in distinct], "a string, b string")
    hashed = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    bucket = {
        (row.a,) if row.b is None else (row.a, row.b): row.n
        for row in frame.select("a", "b", F.pmod(hashed, F.lit(quality_rules.BUCKETS)).alias("n")).collect()
    }
    raw = Counter(bucket[gram] for part in grams.values() for gram in part)
    target = Counter(bucket[gram] for i in trusted for gram in grams[i])
    n, m = sum(raw.values()), sum(target.values())
    prior = max(0.05 * m, 0.5 * quality_rules.BUCKETS)
    rows = _verdicts(docs_of(texts), spark.createDataFrame([(i,) for i in trusted], "doc_id long"))
    for i, part in grams.items():
        ratios = [math.log((target[bucket[g]] + prior * raw[bucket[g]] / n) / ((m + prior) * raw[bucket[g]] / n)) for g in part]
        assert abs(rows[i].log_ratio - sum(ratios) / len(ratios)) < 1e-3


def test_rules_without_trusted_rows_and_empty_table(spark, docs_of):
    nobody = spark.createDataFrame([], "doc_id long")
    rows = _verdicts(docs_of([(1, " ".join(map(str, range(60)))), (None, None)]), nobody)
    assert rows[1].kept and rows[1].log_ratio == 0 and rows[None].base_failed
    assert _verdicts(docs_of([]), nobody) == {}


def _expected(texts):
    groups = {}
    plain = {i: re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for i, text in texts.items()}
    for i, text in plain.items():
        groups.setdefault(text, []).append(i)
    return {(i, min(groups[t]), len(groups[t]), i == min(groups[t]), brute.sha(t)) for i, t in plain.items()}


def test_copies_equal_brute_force(docs_of, odd_texts, small_texts):
    texts = dict(enumerate(odd_texts)) | {100 + i: text for i, text in small_texts.items()}
    texts |= {1000 + i: "often \n copied" if i % 3 else "often copied" for i in range(150)} | {2000 + i: "rare" for i in range(3)}
    for settings in ({}, {"min_copies": 2}, {"most": 1, "tracked": 16}):
        rows = exact_dedup.exact_duplicates(docs_of(texts.items()), **settings).collect()
        assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows} == _expected(texts)
        assert len(rows) == len(texts)


def test_copies_with_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = exact_dedup.exact_duplicates(docs_of([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, None), (3, "")])).collect()
    found = sorted((r.doc_id or 0, r.text_sha256[:2], r.keep_id or 0, r.group_size, r.kept) for r in rows)
    a, b, empty = (brute.sha(text)[:2] for text in ("a", "b", ""))
    assert found == sorted([(0, a, 1, 3, False), (0, b, 0, 1, True), (1, a, 1, 3, True), (1, a, 1, 3, True), (2, empty, 2, 2, True), (3, empty, 2, 2, False)])
    assert exact_dedup.exact_duplicates(docs_of([])).collect() == []
