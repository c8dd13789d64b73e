"""Exact top-k by inner product, with an index of distances to pivots.

Vectors get one more component that gives all of them the same length; then the largest inner product with a
query is the smallest distance to it.  Each vector is keyed by its nearest pivot and its distance, so the vectors
of a pivot lie in rings.  A query visits rings in the order of the largest score that the triangle inequality allows in
them, and stops where that is less than the last score it would keep.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import share_code, stored
from gridtide.llm.tokens import chunks

PIVOTS = 64
RINGS = 64  # of each pivot
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 65_536
SAMPLE_CELLS = 1 << 20  # numbers in the sample that places the pivots
_BINS = 1024  # of the distance to a pivot, from which rings are put together
_WIDTHS = (1, 16, 256)  # rings in the first rounds
_ITEMS = 1_000_000
_ROUNDING = 4e-6  # of the squared lengths; well above what distances in doubles are off by


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """One row per vector; shorter ones end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy()
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """``vec_id``, ``vector``: floor(scale * x) of every component, as whole doubles.

    Vectors that are null or hold a null or a number that is not finite are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "vector", _ITEMS):
            column = batch.column("vector")
            flat = np.floor(scale * column.flatten().to_numpy()) + 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.ListArray.from_arrays(pc.subtract(column.offsets, column.offsets[0]), pa.array(flat))],
                names=["vec_id", "vector"],
            )

    share_code(vectors.sparkSession)
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    read = vectors.where(F.col(embedding).isNotNull() & finite)
    read = read.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    return read.mapInArrow(run, "vec_id long, vector array<double>")


@dataclass(frozen=True)
class PivotIndex:
    """Pivots in the space with one more component, and the rings around them."""

    pivots: np.ndarray  # one row each, the added component last
    most: float  # the squared length of the longest vector, which all have in that space
    owner: np.ndarray  # pivot of each ring
    low: np.ndarray  # least and greatest distance in each ring
    high: np.ndarray
    first_block: np.ndarray  # of each ring, and one past the last
    ring_of: np.ndarray  # by pivot and bin

    @property
    def width(self) -> int:
        return self.pivots.shape[1] - 1

    def highest(self, queries: np.ndarray) -> np.ndarray:
        """For every query and ring, a score that no vector of the ring is above."""
        lengths = (queries**2).sum(axis=1)[:, None]
        squares = lengths + (self.pivots**2).sum(axis=1) - 2 * queries @ self.pivots[:, :-1].T
        to_pivot = np.sqrt(np.maximum(squares, 0.0))[:, self.owner]
        nearest = np.maximum(np.maximum(to_pivot - self.high, self.low - to_pivot), 0.0)
        return (lengths + self.most - nearest**2) / 2 + _ROUNDING * (lengths + self.most) + 1


def _to_pivots(rows: np.ndarray, pivots: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest pivot of every vector, and the distance to it."""
    added = np.sqrt(np.maximum(most - (rows**2).sum(axis=1), 0.0))
    squares = most + (pivots**2).sum(axis=1) - 2 * (rows @ pivots[:, :-1].T + added[:, None] * pivots[:, -1])
    nearest = squares.argmin(axis=1)
    return nearest, np.sqrt(np.maximum(squares[np.arange(len(rows)), nearest], 0.0))


def _placed_pivots(sample: np.ndarray, most: float, count: int) -> np.ndarray:
    """Means of the groups that a few rounds of nearest means find in a sample."""
    full = np.column_stack([sample, np.sqrt(np.maximum(most - (sample**2).sum(axis=1), 0.0))])
    pivots = np.unique(full, axis=0)
    pivots = pivots[np.random.default_rng(7).permutation(len(pivots))[:count]]
    for _ in range(5):
        nearest, _ = _to_pivots(sample, pivots, most)
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest, full)
        sizes = np.bincount(nearest, minlength=len(pivots))[:, None]
        pivots = np.where(sizes > 0, sums / np.maximum(sizes, 1), pivots)
    return pivots


def build_index(candidates: DataFrame, pivots: int, rings: int, rows_per_block: int) -> tuple[PivotIndex, DataFrame]:
    """The index, and ``block``, ``vec_id``, ``vector`` of every row of ``candidates``.

    Pivots come from a sample of at most ``SAMPLE_CELLS`` numbers; all else is from all rows.  The driver gets
    counts of at most ``pivots`` * ``_BINS`` bins.  A ring of many rows is dealt over blocks by a hash.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    width, most = candidates.agg(F.max(F.size("vector")), F.max(square)).first()
    width, most = width or 0, most or 0.0
    drawn = candidates.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(max(1, SAMPLE_CELLS // max(1, width)))
    sample = drawn.toArrow()["vector"].combine_chunks()
    placed = _placed_pivots(_matrix(sample, width), most, pivots) if len(sample) else np.zeros((1, width + 1))
    per_bin = _BINS / (2 * np.sqrt(most) or 1.0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "vector", _ITEMS):
            nearest, distance = _to_pivots(_matrix(batch.column("vector"), width), placed, most)
            cell = nearest * _BINS + np.minimum((distance * per_bin).astype(np.int64), _BINS - 1)
            arrays = [batch.column("vec_id"), batch.column("vector"), pa.array(cell), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector", "cell", "distance"])

    keyed = stored(candidates.mapInArrow(measure, "vec_id long, vector array<double>, cell long, distance double"), "keyed")
    cells = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"))
    cells = cells.orderBy("cell").toArrow()
    cell, n, low, high = (cells[name].to_numpy() for name in ("cell", "n", "low", "high"))
    owner = cell // _BINS
    own = np.bincount(owner, weights=n, minlength=len(placed))[owner]
    before = np.cumsum(n) - n
    start = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=n, minlength=len(placed)))])[owner]
    # Bins go to the ring that the first of their rows, counted from the pivot, falls into.
    share = np.floor((before - start) * rings / np.maximum(own, 1)).astype(np.int64)
    names, ring = np.unique(owner * rings + np.minimum(share, rings - 1), return_inverse=True)
    lows, highs = np.full(len(names), np.inf), np.zeros(len(names))
    np.minimum.at(lows, ring, low)
    np.maximum.at(highs, ring, high)
    blocks = np.ceil(np.bincount(ring, weights=n, minlength=len(names)) / rows_per_block).astype(np.int64)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    ring_of = np.zeros(len(placed) * _BINS, np.int64)
    ring_of[cell] = ring
    index = PivotIndex(placed, most, names // rings, lows, highs, first_block, ring_of)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = index.ring_of[batch.column("cell").to_numpy()]
            sizes = index.first_block[rings + 1] - index.first_block[rings]
            block = index.first_block[rings] + batch.column("hash").to_numpy() % np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("vec_id"), batch.column("vector")], names=["block", "vec_id", "vector"])

    hashed = keyed.select("cell", F.xxhash64("vec_id", "vector").alias("hash"), "vec_id", "vector")
    return index, stored(hashed.mapInArrow(deal, "block long, vec_id long, vector array<double>"), "index")


def _visits(queries: DataFrame, index: PivotIndex, first: int, last: int) -> DataFrame:
    """``block``, ``query``, ``vector``, ``least`` for the rings ``first`` to ``last`` in each query's order, as far as it has to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, max(1, _ITEMS // max(1, len(index.owner)))):
            high = index.highest(_matrix(batch.column("vector"), index.width))
            order = np.argsort(-high, axis=1, kind="stable")[:, first:last]
            least = batch.column("least").cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy()
            row, place = np.nonzero(np.take_along_axis(high, order, axis=1) >= least[:, None])
            ring = order[row, place]
            sizes = index.first_block[ring + 1] - index.first_block[ring]
            row = np.repeat(row, sizes)
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            block = np.repeat(index.first_block[ring], sizes) + within
            for at in range(0, len(row), 10_000):
                part = pa.array(row[at : at + 10_000])
                arrays = [pa.array(block[at : at + 10_000]), *[batch.column(name).take(part) for name in ("query", "vector", "least")]]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "query", "vector", "least"])

    return queries.mapInArrow(run, "block long, query long, vector array<double>, least long")


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products.  Doubles are exact while no sum of absolute products can reach 2**53."""
    longest = [np.sqrt((side**2).sum(axis=1).max(initial=0.0)) for side in (queries, rows)]
    if longest[0] * longest[1] < 2.0**52:
        return (queries @ rows.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (queries, rows)]
    return (whole[0] @ whole[1].T).astype(np.int64)


def _best(scores: np.ndarray, least: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``keep`` highest scores of every row that reach ``least``; of equal ones the first columns."""
    floor = least[:, None]
    if scores.shape[1] > keep:
        floor = np.maximum(floor, np.partition(scores, scores.shape[1] - keep, axis=1)[:, -keep][:, None])
    row, column = np.nonzero(scores >= floor)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < keep], column[place < keep]


def _scored(index_rows: DataFrame, visits: DataFrame, width: int, keep: int) -> DataFrame:
    """``query``, ``score``, ``vec_id``, ``same`` (whether the vectors are equal) of the best rows of each visited block."""
    counts = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).cast("int").alias("slices"))
    counts = stored(counts, "visited")
    none = F.lit(None).cast("long")
    data = index_rows.join(counts, "block").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    data = data.select("block", "slice", F.lit(0).alias("tag"), F.col("vec_id").alias("id"), "vector", none.alias("least"))
    asked = visits.join(counts, "block").withColumn("slice", F.pmod(F.xxhash64("query"), F.col("slices")).cast("int"))
    asked = asked.select("block", "slice", F.lit(1).alias("tag"), F.col("query").alias("id"), "vector", "least")
    # The rows of a block come first; the queries then pass by them.
    dealt = data.unionByName(asked).repartition("block", "slice").sortWithinPartitions("block", "slice", "tag", F.col("id").asc_nulls_last())
    schema = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64()), ("same", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        rows, ids = np.zeros((0, width)), pa.array([], pa.int64())
        for batch in chunks(batches, "vector", _ITEMS):
            block, part, tag = (batch.column(name).to_numpy() for name in ("block", "slice", "tag"))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(tag) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                own = batch.slice(low, high - low)
                vectors, key = _matrix(own.column("vector"), width), (int(block[low]), int(part[low]))
                if tag[low] == 0:
                    if key != at:
                        rows, ids, at = np.zeros((0, width)), pa.array([], pa.int64()), key
                    rows, ids = np.concatenate([rows, vectors]), pa.concat_arrays([ids, own.column("id")])
                    continue
                least = own.column("least").fill_null(-(1 << 63)).to_numpy()
                step = max(1, 4 * _ITEMS // max(1, len(rows)))
                for first in range(0, len(vectors), step):
                    some = vectors[first : first + step]
                    scores = _products(some, rows)
                    row, column = _best(scores, least[first : first + step], keep)
                    same = (some[row] == rows[column]).all(axis=1)
                    names = own.column("id").take(pa.array(first + row))
                    arrays = [names, pa.array(scores[row, column]), ids.take(pa.array(column)), pa.array(same)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return dealt.mapInArrow(run, "query long, score long, vec_id long, same boolean")


def _first(df: DataFrame, key: Sequence[str], order: Sequence, count: int) -> DataFrame:
    """The first ``count`` rows of every key; Spark limits them in each task before they move."""
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_number", number).where(F.col("_number") <= count).drop("_number")


def top_k(
    vectors: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    every: int = 100,
    scale: float = 1024.0,
    pivots: int = PIVOTS,
    rings: int = RINGS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` rows with the largest inner product for every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's own.  Ties go to the
    smaller id, a row without an id comes last.  Of equal vectors only the k + 1 smallest ids can be in a result, so the
    others are left out before the index is built; equal queries are searched for once.

    Vectors that are null or hold a null or a number that is not finite take no part; shorter vectors count as
    ending in zeros.  Rows that repeat an id are rows of their own, as queries too.  An empty table gives no
    rows; other columns are not read.  A score beyond the range of a long stops the job with ``OverflowError``.
    """
    keep = k + 1
    rows = stored(whole_vectors(vectors, vec_id, embedding, scale), "vectors")
    candidates = stored(_first(rows, ["vector"], [F.col("vec_id").asc_nulls_last()], keep), "candidates")
    asking = rows.where(F.col("vec_id") % every == 0)
    queries = stored(asking.select("vector").distinct().select(F.monotonically_increasing_id().alias("query"), "vector"), "queries")
    index, index_rows = build_index(candidates, pivots, rings, rows_per_block)
    best = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("same").desc()]
    found, first, total = None, 0, len(index.owner)
    for width in (*_WIDTHS, total):
        least = queries.withColumn("least", F.lit(None).cast("long"))
        if found is not None:
            reached = found.groupBy("query").agg(F.when(F.count(F.lit(1)) >= keep, F.min("score")).alias("least"))
            least = queries.join(reached, "query", "left")
        visits = stored(_visits(least, index, first, min(first + width, total)), "visits")
        if first >= total or visits.isEmpty():
            break
        scored = _scored(index_rows, visits, index.width, keep)
        found = stored(_first(scored if found is None else scored.unionByName(found), ["query"], best, keep), "found")
        first += width
    if found is None:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))

    entry = F.struct((-F.col("score")).alias("down"), F.col("vec_id").isNull().alias("no_id"), "vec_id", (~F.col("same")).alias("other"), "score")
    tops = found.groupBy("query").agg(F.sort_array(F.collect_list(entry)).alias("top"))  # k + 1 entries at most
    answered = asking.select("vec_id", "vector").join(queries, "vector").select(F.col("vec_id").alias("query_id"), "query").join(tops, "query")
    itself = F.transform("top", lambda item: ~item["other"] & (item["vec_id"] == F.col("query_id")))
    place = F.array_position(itself, F.lit(True))
    others = F.filter("top", lambda item, i: i + 1 != F.col("place"))
    answered = answered.withColumn("place", place).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "item"))
    return answered.select("query_id", (F.col("rank") + 1).alias("rank"), "item.vec_id", "item.score")
