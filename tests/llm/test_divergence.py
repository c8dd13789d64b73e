import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridtide.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, item string"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, source, 5, "x", "y") for i, (text, lang, source) in enumerate(rows)], SCHEMA)


def expected(rows, min_docs, top):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = set()
    for lang in {lang for lang, _ in groups}:
        kept = [term for term, n in seen[lang].items() if n >= min_docs]
        sources = sorted((s for one, s in groups if one == lang), key=str.encode)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(of, term):
            return 1 + 10**9 * (of[term] + 2) // (sum(of[t] for t in kept) + 2 * len(kept))

        def rank(values, part, source):
            ordered = sorted(values, key=lambda pair: (-pair[1], pair[0].encode()))
            return {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)}

        for source in sources:
            own = counts[lang, source]
            p = {term: share(own, term) for term in kept}
            far = []
            for other in sources:
                if other != source:
                    q = {term: share(counts[lang, other], term) for term in kept}
                    far.append((other, sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept)))
            out |= rank(far, "pair", source)
            q = {term: share(whole, term) for term in kept}
            above = [(t, (p[t] - q[t]) ** 2 // (p[t] + q[t])) for t in kept if own[t] and p[t] > q[t]]
            out |= {row for row in rank(above, "term", source) if row[-1] <= top}
    return out


def rows_of(found):
    return [tuple(row) for row in found.select("lang", "source", "part", "item", "value", "rank").collect()]


def made_rows(seed, many):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma9delta", "é", "한글", "zeta-eta", "Ω", "ÀB", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for _ in range(many):
        picked = rng.choices(words, weights=[1 + i % 5 for i in range(len(words))], k=rng.randrange(12))
        rows.append((" ".join(picked), rng.choice(["de", "en", None, ""]), rng.choice(["a", "b", None, "c", "ü"])))
    return rows


@pytest.mark.parametrize("min_docs, top", [(1, 3), (8, 10), (10_000, 10)])
def test_equals_brute_force(spark, min_docs, top):
    rows = made_rows(min_docs, 150) + [(None, "xx", "only"), ("", "de", "no terms"), ("1 2 3", None, None), ("w " * 20_000, "en", "a")]
    found = rows_of(divergence.source_divergence(table(spark, rows), min_docs=min_docs, top=top))
    assert len(found) == len(set(found)) and set(found) == expected(rows, min_docs, top)


def test_repeated_rows_count_and_an_empty_table_gives_none(spark):
    rows = made_rows(3, 30) * 4
    assert set(rows_of(divergence.source_divergence(table(spark, rows), min_docs=6))) == expected(rows, 6, 10)
    assert rows_of(divergence.source_divergence(table(spark, []))) == []


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_of_many_terms(k):
    rng = np.random.default_rng(k)
    n, total = rng.integers(1, 9, 900), rng.integers(5, 15, 900)
    terms = [f"t{i}".encode() for i in rng.permutation(900)]
    dominators = [sum(n[j] >= n[i] and total[j] <= total[i] and terms[j] < terms[i] for j in range(900)) for i in range(900)]
    assert sorted(divergence.undominated(n, total, terms, k)) == [i for i in range(900) if dominators[i] < k]


def test_merged_skybands_keep_the_first_of_every_group(spark):
    rng = random.Random(1)
    rows = [(f"l{i % 2}", f"s{i % 3}", f"t{rng.random()}", rng.randrange(1, 30), rng.randrange(30, 60), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, total long, value long").repartition(7)
    merged = divergence.skybands(divergence.skybands(df, 4).repartition("lang", "source"), 4)
    assert merged.count() < 600
    kept = {tuple(row) for row in merged.collect()}
    for lang, source in {row[:2] for row in rows}:
        own = sorted((row for row in rows if row[:2] == (lang, source)), key=lambda row: (-row[3] / row[4], row[2]))
        assert set(own[:4]) <= kept


def test_shares_of_large_counts_are_exact():
    counts, totals = np.array([[0, 10**12, 3 * 10**14]]), np.array([7, 3 * 10**12, 3 * 10**14 + 2])
    assert divergence._shares(counts, totals).tolist() == [[1 + 10**9 * (c + 2) // t for c, t in zip(counts[0].tolist(), totals.tolist())]]


_COUNT_MANY = """
import pyarrow as pa
from gridtide.llm import divergence

letters = bytes(range(97, 123)).decode()
name = lambda i: "".join(letters[i // 26**k % 26] for k in range(5))
texts = [" ".join(map(name, range(first, first + 50_000))) for first in range(0, 2_500_000, 50_000)]
batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(["web"] * len(texts)), pa.array(texts)], ["lang", "source", "text"])
del texts
before = pa.default_memory_pool().max_memory()
rows = [(part.num_rows, sum(part["n"].to_pylist())) for part in divergence.counted_chunks(iter([batch]))]
print(*map(sum, zip(*rows)), (pa.default_memory_pool().max_memory() - before) // 1_000_000)
"""


def test_counting_many_terms_holds_little_memory():
    """In a process of its own, as Arrow keeps one peak for all."""
    from gridtide import __path__ as package

    run = subprocess.run([sys.executable, "-c", _COUNT_MANY], cwd=f"{package[0]}/..", capture_output=True, text=True, check=True)
    rows, n, peak_mb = map(int, run.stdout.split())
    assert rows >= n == 2_500_000 and peak_mb < 400


def test_counts_passed_on_early_add_up(monkeypatch):
    monkeypatch.setattr(divergence, "_HELD_ROWS", 5)
    texts = ["a b c d e f g h", "a a i", None, "b c j k l m n o p", "a"] * 3
    batches = [pa.record_batch([pa.array(["en"]), pa.array(["x"]), pa.array([text or ""])], ["lang", "source", "text"]) for text in texts]
    parts = list(divergence.counted_chunks(iter(batches)))
    found, docs = Counter(), Counter()
    for part in parts:
        for row in part.to_pylist():
            found[row["term"]] += row["n"]
            docs[row["term"]] += row["docs"]
    words = [text.split() for text in texts if text]
    assert len(parts) > 1
    assert +found == Counter(sum(words, [])) and {t: n for t, n in docs.items() if t} == Counter(w for own in words for w in set(own))
