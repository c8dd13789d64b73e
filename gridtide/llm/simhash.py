"""SimHash fingerprints, and near duplicates by pigeonring-filtered Hamming links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ROW_HASH, row_hash, stored
from gridtide.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_SLICE = 1 << 16
_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the XXH64 hashes of the shingles; 0 for a text without words."""
    words = text.translate(_LOWER).split()  # bytes split at exactly 0x20 and 0x09-0x0D
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(words) - shingle + 1
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, _SLICE):
        high = min(count, low + _SLICE)
        spans = zip(starts[low:high].tolist(), ends[low + shingle - 1 : high + shingle - 1].tolist())
        hashes = np.array([digest(joined[start:end], SEED) for start, end in spans], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * bits > count).tolist())


def with_fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``ROW_HASH`` and ``fingerprint`` (64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(value.as_py() or b"", shingle) for value in texts], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), batch.column(ROW_HASH), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", ROW_HASH, "fingerprint"])

    source = docs.select(F.col(doc_id).alias("doc_id"), row_hash(text), F.col(text).alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, {ROW_HASH} long, fingerprint long")


def _ring(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``max_bits + 1`` segments around the 64 bits."""
    parts = max_bits + 1
    edges = [64 * part // parts for part in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _segment(bits: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1))


def _within_budgets(apart: Column, ring: list[tuple[int, int]], max_bits: int) -> Column:
    """Whether every chain from ``start`` keeps its budget; the last one is the whole distance."""
    parts = len(ring)

    def spent(start: int, length: int) -> Column:
        order = [ring[(start + step) % parts] for step in range(length)]
        return sum((F.bit_count(_segment(apart, low, width)) for low, width in order), F.lit(0))

    kept = F.lit(True)
    for start in range(parts):
        for length in range(3, parts):
            kept = kept & ((F.col("start") != start) | (spent(start, length) <= length * max_bits // parts))
    return kept & (F.bit_count(apart) <= max_bits)


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most ``max_bits`` bits.

    Pigeonring: with m = max_bits + 1 segments on a ring, any two such fingerprints have a segment
    from which every chain of l segments differs in at most floor(l * max_bits / m) bits: 0 bits in the first
    segment, 1 in the first two, and so on.  The budgets of the first two segments become a join key:
    one side holds its two segments as they are, the other also each way of flipping one bit of the second.  A key then
    has about 128 / m bits, so chance meetings stay rare at billions of fingerprints.  Longer chains
    and the whole distance are checked inside the join, which emits only true links.
    """
    ring, parts = _ring(max_bits), max_bits + 1

    def chain(start: int, column: str) -> list[Column]:
        order = [ring[(start + step) % parts] for step in range(parts)]
        return [_segment(F.col(column), low, width) for low, width in order]

    def key(start: int, column: str, flip: int = 0) -> Column:
        first, second = chain(start, column)[:2]
        return F.struct(F.lit(start).alias("start"), first.alias("first"), second.bitwiseXOR(F.lit(flip)).cast("long").alias("second"))

    if max_bits == 0:
        return nodes.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    exact = F.array(*[key(start, "b") for start in range(parts)])
    flips = [
        key(start, "a", flip)
        for start in range(parts)
        for flip in (0, *(1 << bit for bit in range(ring[(start + 1) % parts][1])))
    ]
    left = nodes.select(F.col("fingerprint").alias("a")).withColumn("key", F.explode(F.array(*flips)))
    right = nodes.select(F.col("fingerprint").alias("b")).withColumn("key", F.explode(exact))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    left, right = left.select("a", "key.*"), right.select("b", "key.*")
    near = (F.col("a") < F.col("b")) & _within_budgets(apart, ring, max_bits)
    return left.join(right.hint("merge"), ["start", "first", "second"]).where(near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` and ``ROW_HASH`` of every row.

    Links and components are found between distinct fingerprints, so copies, however many, are one
    node.  The component id is the smallest ``doc_id`` reachable over links, the row's own included.

    A null text is empty; texts without words share fingerprint 0.  A null id is reachable but never
    the smallest, unless all ids of a component are null.  Repeated rows get equal results; an empty
    table gives no rows; other columns are not read.
    """
    rows = stored(with_fingerprint(docs, doc_id, text, shingle), "fingerprints")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")), "nodes")
    found = components(links(nodes, max_bits))
    rooted = nodes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id", ROW_HASH)


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
