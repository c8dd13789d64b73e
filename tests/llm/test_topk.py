import math
import random

import numpy as np
import pytest

from gridtide.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, query long, block string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "b") for i, v in rows], SCHEMA).repartition(3)


def expected(rows, k=10, every=100, scale=1024.0):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (query, q) in enumerate(whole):
        if query is not None and query % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i) for other, (i, v) in enumerate(whole) if other != place]
            scored.sort(key=lambda row: (row[0], row[1], row[2] or 0))
            out += [(query, rank + 1, i, -score) for rank, (score, _, i) in enumerate(scored[:k])]
    return sorted(map(str, out))


def found_in(spark, rows, **settings):
    found = topk.top_k(table(spark, rows), **settings)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(str(tuple(row)) for row in found.collect())


def vectors(seed, count, width=6, near=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width)) * 3
    made = centres[rng.integers(0, 5, count)] + rng.normal(size=(count, width)) * (0.1 if near else 1)
    return [(i, row.tolist()) for i, row in enumerate(made)]


@pytest.mark.parametrize("near", [0, 1])
def test_equals_brute_force(spark, near):
    rows = vectors(near, 700, near=near)
    assert found_in(spark, rows, every=20, pivots=6, rings=8, rows_per_block=16) == expected(rows, every=20)


def test_far_rings_are_not_visited(spark):
    rows = vectors(4, 3000, near=1)
    candidates = topk.whole_vectors(table(spark, rows), "vec_id", "embedding", 1024.0)
    index, stored = topk.build_index(candidates, 8, 16, 64)
    assert stored.count() == 3000 and index.first_block[-1] >= 3000 // 64
    query = np.floor(1024 * np.array([rows[0][1]]))
    high = index.highest(query)[0]
    scores = {row.block: [] for row in stored.select("block").distinct().collect()}
    for row in stored.collect():
        scores[row.block].append(float(np.dot(query[0], row.vector)))
    for ring in range(len(index.owner)):
        for block in range(index.first_block[ring], index.first_block[ring + 1]):
            assert max(scores.get(block) or [-math.inf]) <= high[ring]
    eleventh = sorted(sum(scores.values(), []))[-11]
    assert (high < eleventh).sum() > len(high) / 2


def test_ties_copies_and_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5]) for i in range(0, 400, 2)]  # a third of all, many of them queries
    rows += [(i, [float(rng.randrange(-2, 3)), 0.25]) for i in range(1, 400, 2)]
    rows += [(100, [1.0, 0.5])] * 2 + [(100, [0.0, 2.0]), (None, [1.0, 0.5]), (None, [9.0, 9.0])]
    rows += [(500, None), (600, [None, 1.0]), (700, [math.nan, 1.0]), (800, [math.inf, 1.0]), (900, [3.0]), (1000, []), (7, [1.0, 1.0, -5.0])]
    assert found_in(spark, rows, rows_per_block=8, pivots=3, rings=4) == expected(rows)


def test_few_rows_and_none(spark):
    assert found_in(spark, []) == []
    assert found_in(spark, [(100, [1.0])]) == []
    assert found_in(spark, [(1, [1.0]), (2, [2.0])]) == []
    rows = [(0, [-0.5, 1.0]), (1, [1.0, 2.0]), (200, [0.0, 0.0])]
    assert found_in(spark, rows) == expected(rows)


def test_long_components_stay_exact(spark):
    rows = [(i, [float(2**18 + i), float(3**9 * i), -7.0]) for i in range(0, 30)]
    assert found_in(spark, rows, every=10) == expected(rows, every=10)
    with pytest.raises(Exception, match="OverflowError"):
        found_in(spark, [(0, [1e18, 1e18]), (1, [1e18, 1e18])])
