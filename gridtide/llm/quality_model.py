"""Quality scores from document statistics by histogram gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.boosting import Forest, fit
from gridtide.llm.labelled import training_sample

TRAINING_ROWS = 20_000
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>{}[]^~_=+\\/@"))
_STOPS = np.isin(np.arange(256), list(b".,;:!?"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STATISTICS = (
    "log words", "bytes per word", "symbols", "stops", "exclamations", "capitals", "digits", "high bytes", "lines per word",
    "distinct words", "distinct lines", "repeated neighbours", "distinct triples", "commonest word", "longest word",
)


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text; shares are of bytes, words or lines.  An empty text is all zero."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    triples = (codes[:-2] * n + codes[1:-1]) * 1_000_003 + codes[2:] if n > 2 else codes[:1]
    visible = size - int(counts[_BLANK].sum())
    return [
        float(np.log1p(n)),
        visible / n,
        counts[_SYMBOLS].sum() / size,
        counts[_STOPS].sum() / size,
        counts[33] / n,
        counts[_UPPER].sum() / size,
        counts[_DIGIT].sum() / size,
        counts[128:].sum() / size,
        len(lines) / n,
        len(numbers) / n,
        len(set(lines)) / len(lines),
        float((codes[1:] == codes[:-1]).mean()) if n > 1 else 0.0,
        len(np.unique(triples)) / len(triples),
        float(np.bincount(codes).max()) / n,
        float(np.log1p(max(map(len, words)))),
    ]


def _table(texts: pa.Array) -> np.ndarray:
    rows = [statistics(value.as_py() or b"") for value in texts.cast(pa.binary())]
    return np.array(rows, float).reshape(-1, len(STATISTICS))


def with_statistics(rows: DataFrame) -> DataFrame:
    """``label`` and the statistics of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(list(_table(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), values], names=["doc_id", "label", "values"])

    return rows.mapInArrow(run, "doc_id long, label int, values array<double>")


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, most: int = TRAINING_ROWS, **settings) -> Forest:
    """Trees fitted on at most ``most`` labelled rows; their statistics, not their texts, reach the driver."""
    sample = with_statistics(training_sample(docs, labels, "quality", learn_from, most)).orderBy("doc_id").collect()
    rows = np.array([row["values"] for row in sample], float).reshape(-1, len(STATISTICS))
    return fit(rows, np.array([row["label"] for row in sample], float), **settings)


def quality_scores(
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

    A null text is empty and is scored by its zero statistics.  Repeated rows get equal scores, a null id
    keeps its row, an empty table gives no rows, and other columns are not read.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # A few thousand nodes.
    model = docs.sparkSession.sparkContext.broadcast(train(source, labels, learn_from, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.value.score(_table(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    return source.mapInArrow(run, "doc_id long, score double")
