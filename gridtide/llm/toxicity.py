"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.labelled import training_sample

TRAINING_ROWS = 20_000
BUCKETS = 1 << 18
_STEM = 4
_TERMS = re.compile(r"[^\W\d_]+").findall


@lru_cache(maxsize=200_000)
def _bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % BUCKETS


def terms(text: str | None) -> np.ndarray:
    """Distinct buckets of the lower-case words of a text and of the stems (first letters) of longer ones."""
    words = set(_TERMS((text or "").lower()))
    stems = {f"{word[:_STEM]}-" for word in words if len(word) > _STEM}
    return np.array(sorted(set(map(_bucket, words)) | set(map(_bucket, stems))), np.int32)


@dataclass
class Machine:
    """``bias + sum w[t] + sum over pairs <v[t], v[u]>`` over the terms t, u of a text."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; the pair sum is ((sum v)^2 - sum v^2) / 2, linear in the terms."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        total = self.bias + np.bincount(row, self.weight[flat], len(sizes))
        for part in self.factor.T:
            picked = part[flat]
            total += 0.5 * (np.bincount(row, picked, len(sizes)) ** 2 - np.bincount(row, picked**2, len(sizes)))
        return total

    def score(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(flat, sizes), -30, 30)))


def fit(
    bags: list[np.ndarray],
    labels: np.ndarray,
    factors: int = 4,
    epochs: int = 60,
    batch: int = 512,
    rate: float = 0.3,
    ridge: float = 2e-4,
    least_rows: int = 3,
    least_z: float = 5.0,
) -> Machine:
    """Adagrad on the logistic loss.

    Terms in fewer than ``least_rows`` rows, and terms whose shares in the two classes differ by less than
    ``least_z`` standard errors, stay at zero, so that the many neutral words of a long text add no noise.
    One class or no rows give the smoothed share of ones for every text.
    """
    rng = np.random.default_rng(11)
    count = len(labels)
    share = (labels.sum() + 0.5) / (count + 1)
    weight, factor = np.zeros(BUCKETS), np.zeros((BUCKETS, factors))
    if count == 0 or labels.min() == labels.max():
        return Machine(float(np.log(share / (1 - share))), weight, factor)
    row_of = np.repeat(np.arange(count), [len(bag) for bag in bags])
    seen = np.bincount(np.concatenate(bags), minlength=BUCKETS)
    ones = np.bincount(np.concatenate(bags), labels[row_of], BUCKETS)
    positive, negative = labels.sum(), count - labels.sum()
    share_seen = seen / count
    error = np.sqrt(np.maximum(share_seen * (1 - share_seen), 1e-12) * (1 / positive + 1 / negative))
    often = (seen >= least_rows) & (np.abs(ones / positive - (seen - ones) / negative) >= least_z * error)
    bags = [bag[often[bag]] for bag in bags]
    factor[often] = rng.normal(0, 0.01, (int(often.sum()), factors))
    machine = Machine(float(np.log(share / (1 - share))), weight, factor)
    past_weight, past_factor, past_bias = np.full(BUCKETS, 1e-2), np.full((BUCKETS, factors), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(count)
        for low in range(0, count, batch):
            chosen = order[low : low + batch]
            sizes = np.array([len(bags[i]) for i in chosen])
            flat = np.concatenate([bags[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), sizes)
            error = (machine.score(flat, sizes) - labels[chosen]) / len(chosen)
            places, back = np.unique(flat, return_inverse=True)
            step = np.bincount(back, error[row], len(places)) + ridge * weight[places] / count
            past_weight[places] += step**2
            weight[places] -= rate * step / np.sqrt(past_weight[places])
            for f in range(factors):
                picked = factor[flat, f]
                sums = np.bincount(row, picked, len(chosen))
                step = np.bincount(back, error[row] * (sums[row] - picked), len(places)) + ridge * factor[places, f]
                past_factor[places, f] += step**2
                factor[places, f] -= 0.1 * rate * step / np.sqrt(past_factor[places, f])
            past_bias += error.sum() ** 2
            machine.bias -= rate * float(error.sum()) / float(np.sqrt(past_bias))
    return machine


def _bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bags = [terms(text) for text in texts.to_pylist()]
    return np.concatenate([np.zeros(0, np.int32), *bags]), np.array([len(bag) for bag in bags], np.int64)


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, most: int = TRAINING_ROWS, **settings) -> Machine:
    """A machine fitted on at most ``most`` labelled rows; their bucket numbers, not their texts, reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = pa.array([terms(text) for text in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), bags], names=["doc_id", "label", "terms"])

    sample = training_sample(docs, labels, "toxic", learn_from, most)
    table = sample.mapInArrow(run, "doc_id long, label int, terms array<int>").orderBy("doc_id").toArrow()
    bags = [np.asarray(bag.values, np.int32) for bag in table.column("terms")]
    return fit(bags, table.column("label").to_numpy().astype(float), **settings)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = TRAINING_ROWS,
) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every row, from its whole text.

    ``learn_from`` is a condition on ``doc_id`` for rows whose labels may be used.  Without usable
    labels, or with one class only, all rows get the smoothed share of ones.

    A null text is empty and has no terms.  Repeated rows get equal scores, a null id keeps its row, an
    empty table gives no rows, and other columns are not read.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    machine = train(source, labels, learn_from, most)
    machine = Machine(machine.bias, machine.weight.astype(np.float32), machine.factor.astype(np.float32))
    # BUCKETS rows of 20 bytes.
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.value.score(*_bags(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    return source.mapInArrow(run, "doc_id long, score double")
