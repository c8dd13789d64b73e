import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.llm import boosting, quality_model, toxicity
from gridtide.llm.labelled import fold, training_sample

def _any():
    return F.lit(True)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_folds(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 5).alias("n")).collect()
    assert all(row.n == zlib.crc32(str(row.id).encode()) % 5 for row in rows)


def test_trees_against_a_walk_of_one_row():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 5))
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] > -0.1)).astype(float)
    forest = boosting.fit(rows, labels, trees=20, depth=3)
    nodes = (1 << 4) - 1

    def walk(row):
        total = forest.start
        for tree in range(forest.trees):
            at = 0
            while forest.feature[tree * nodes + at] >= 0:
                place = tree * nodes + at
                at = 2 * at + 1 + int(row[forest.feature[place]] > forest.limit[place])
            total += forest.value[tree * nodes + at]
        return total

    assert np.allclose(forest.raw(rows), [walk(row) for row in rows])
    assert ((forest.score(rows) >= 0.5) == labels).mean() > 0.95


def test_machine_against_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(0.3, rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, 3)))
    bags = [np.array([5, 9, 77]), np.array([], int), np.array([1000])]
    found = machine.raw(np.concatenate(bags).astype(int), np.array([3, 0, 1]))
    for bag, value in zip(bags, found):
        pairs = sum(machine.factor[a] @ machine.factor[b] for i, a in enumerate(bag) for b in bag[i + 1 :])
        assert value == pytest.approx(0.3 + machine.weight[bag].sum() + pairs)


def test_machine_learns_a_pair_that_no_single_term_shows():
    """Label 1 only where an insult stands beside a group; each alone is harmless."""
    rng = random.Random(3)
    bags, labels = [], []
    for _ in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(50)}" for _ in range(6)] + ["clown"] * insult + ["people"] * group
        bags.append(toxicity.terms(" ".join(words)))
        labels.append(float(insult and group))
    machine = toxicity.fit(bags[:1000], np.array(labels[:1000]))
    flat, sizes = np.concatenate(bags[1000:]), np.array([len(bag) for bag in bags[1000:]])
    assert ((machine.score(flat, sizes) >= 0.5) == np.array(labels[1000:])).mean() > 0.95


def _held_out(spark, column, folds, part, scores_of):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = fold(F.col("doc_id"), folds) == part
    scores = scores_of(docs, labels, ~held)
    rows = scores.where(held).join(labels, "doc_id").select("score", column).collect()
    return np.array([row.score >= 0.3 for row in rows]), np.array([row[column] == 1 for row in rows])


def test_quality_on_held_out_rows(spark):
    found, true = _held_out(spark, "quality", 5, 0, quality_model.quality_scores)
    assert (found == true).mean() > 0.98


def test_toxicity_on_held_out_rows(spark):
    found, true = _held_out(spark, "toxic", 4, 2, toxicity.toxicity_scores)
    assert found[true].mean() > 0.9 and found[~true].mean() < 0.02


@pytest.mark.parametrize("scores_of", [quality_model.quality_scores, toxicity.toxicity_scores])
def test_odd_texts_ids_and_labels(spark, docs_of, odd_texts, scores_of):
    texts = [*enumerate(odd_texts), (0, None), (None, "x")]
    labels = _labels(spark, [(i, i % 2, i % 2) for i in range(12)] + [(3, 0, 0), (4, None, None), (None, 1, 1)])
    scores = scores_of(docs_of(texts), labels, _any()).collect()
    assert len(scores) == len(texts) and all(0 <= row.score <= 1 for row in scores)
    assert len({row.score for row in scores if row.doc_id in (5, 6)}) == 1  # repeated texts
    same = scores_of(docs_of(texts), _labels(spark, [(1, 1, 1)]), _any()).collect()
    assert {row.score for row in same} == {0.75}  # one class: the smoothed share
    assert {row.score for row in scores_of(docs_of(texts), _labels(spark, []), _any()).collect()} == {0.5}
    assert scores_of(docs_of([]), labels, _any()).collect() == []


def test_the_sample_is_bounded_and_settled(spark, docs_of):
    labels = _labels(spark, [(i, i % 2, 0) for i in range(30)] + [(1, 0, 0)])
    docs = docs_of([str(i) for i in range(40)])
    first = {row.doc_id for row in training_sample(docs, labels, "quality", F.col("doc_id") > 3, 10).collect()}
    again = {row.doc_id for row in training_sample(docs.repartition(7), labels, "quality", F.col("doc_id") > 3, 10).collect()}
    assert first == again and len(first) == 10 and min(first) > 3
    assert 1 not in {row.doc_id for row in training_sample(docs, labels, "quality", _any(), 100).collect()}
