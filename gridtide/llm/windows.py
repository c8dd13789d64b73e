"""Hashes of all windows of a text at once, and the stored texts that window operators read again."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import release, whole_text
from gridtide.llm.tokens import chunks
from gridtide.session import scratch_path

# Two streams for 128 bits: an odd multiplier and the seed of the symbol table of each.
_STREAMS = ((0x9E3779B97F4A7C15, 1), (0xC2B2AE3D27D4EB4F, 2))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Hashes of equal-length or cut-out runs of symbols by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, stream: int):
        base, seed = _STREAMS[stream]
        self.up, self.down = base, pow(base, -1, 1 << 64)
        self.powers = {}
        self.table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))

    def _power(self, base: int, count: int) -> np.ndarray:
        have = self.powers.get(base)
        if have is None or len(have) < count:
            have = np.full(max(count, 1 << 16), base, np.uint64)
            have[0] = 1
            self.powers[base] = have = np.multiply.accumulate(have)
        return have[:count]

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self._power(self.up, len(symbols)), out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        down = self._power(self.down, len(prefix))
        return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, symbols: np.ndarray, size: int) -> np.ndarray:
        """Hash of the window at every place where ``size`` symbols follow."""
        count = max(0, len(symbols) - size + 1)
        prefix = self.prefix(symbols)
        return mixed((prefix[size : size + count] - prefix[:count]) * self._power(self.down, count + 1)[:count])


@cache
def rolling(stream: int) -> Rolling:
    """One per Python worker; its tables of powers grow with the longest chunk."""
    return Rolling(stream)


def representatives(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For every place, the place of the smallest of the next ``reach`` hashes, the leftmost of equal ones.

    It depends on the upper half of the hashes alone, so equal stretches choose alike wherever they lie.
    """
    bits = 32
    least = (hashes >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(hashes), dtype=np.uint64)
    have = 1
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        have += step
    return (least & np.uint64((1 << bits) - 1)).astype(np.int64)


def bucketed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row``, ``doc_id``, ``text``, ``digest`` stored in buckets of ``row``, a number of its own for every row.

    The texts move once; later joins on ``row`` move only the narrow side.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        whole_text(text).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    name = f"texts_{uuid.uuid4().hex[:12]}"
    writer = source.repartition(buckets, "row").write.format("parquet").bucketBy(buckets, "row")
    writer.option("path", scratch_path(spark, "texts")).option("compression", "zstd").saveAsTable(name)
    release(spark)
    return spark.table(name)


def first_copies(texts: DataFrame) -> DataFrame:
    """``row``, ``copies``, ``first`` of every row: equal texts are looked at once, at the smallest (id, row)."""
    groups = texts.groupBy("digest").agg(F.min(F.struct("doc_id", "row"))["row"].alias("first_row"), F.count(F.lit(1)).alias("copies"))
    return texts.select("row", "digest").join(groups, "digest").select("row", "copies", (F.col("row") == F.col("first_row")).alias("first"))


def beside(texts: DataFrame, notes: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with their row of ``notes``; the narrow side is hashed, the texts are not sorted."""
    return texts.join(notes.hint("shuffle_hash"), "row", how)


def joined_bytes(batches: Iterable[pa.RecordBatch], most: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Chunks of rows with all bytes of their texts end to end and the offsets of each text."""
    for batch in chunks(batches, "text", most):
        values = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        data = values.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        yield batch, raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs_of(places: np.ndarray) -> list[tuple[int, int]]:
    """First and last of every run of neighbouring numbers in a sorted array."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[[0, *(breaks + 1)]].tolist(), places[[*breaks, len(places) - 1]].tolist()))
