"""Row-position operators over one global order, without a one-partition window.

A window with ORDER BY and no PARTITION BY moves every row to one task.  Here the order is
cut into blocks of about equal row counts, at keys taken from a sample, and each block is
one window partition:

* the key holds all order columns, so a time (or series) that holds a large share of the rows
  is cut between its rows by the later columns;
* rows equal in the whole key cannot be cut.  A key that fills more than a block gets a block of its
  own, which is collapsed to (row, number of copies) with map-side aggregation first, see ``lag``;
* rows near a block start see the last rows of earlier blocks through a halo: at most
  ``max offset`` rows per block, found by a top-n per block that is limited before its shuffle.
  Only the band above a sampled key shortly before the end of each block is ranked for it.

The cut keys are constants once fitted, so recomputed tasks put every row in the same block.
The sample only places the cuts; results do not depend on it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_order_block"
_KEY = "_order_key"
_HALO = "_order_halo"
_RANK = "_order_rank"
_PART = "_order_part"
COPIES = "_order_copies"

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 20_000  # bounds cut keys in a plan, shuffle partitions and rows of every per-block table
_MAX_SAMPLE = 1_000_000
_EXPAND_CHUNK = 100_000
_DEPTHS = (1, 8, 24)  # distances before a cut at which sampled keys are kept

# Cut keys pass through JSON text; these formats keep every microsecond.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}


def _key(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(name).alias(f"k{position}") for position, name in enumerate(order_by)])


@dataclass(frozen=True)
class OrderedBlocks:
    """Cut keys of one global order."""

    order_by: tuple[str, ...]
    key_type: T.StructType
    cuts: tuple[str, ...] = ()  # JSON text of each cut key, ascending
    split: tuple[int, ...] = ()  # cuts, counted from 1, whose key has a block to itself
    spare: tuple[int, ...] = ()  # blocks that the copies of each such key fill beyond that; none once collapsed
    sampled: tuple[tuple[str | None, ...], ...] = ()  # see ``_near_end``; one list per depth of ``_DEPTHS``

    @property
    def blocks(self) -> int:
        return len(self.cuts) + 1 + len(self.split)

    @property
    def heavy(self) -> dict[int, int]:
        """Blocks of a single key that is too frequent to be cut, with their spare blocks."""
        return {cut + before: spare for before, (cut, spare) in enumerate(zip(self.split, self.spare))}

    @classmethod
    def fit(cls, df: DataFrame, order_by: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> OrderedBlocks:
        """One count and one sampled pass over the order columns; one key per cut comes back.

        Only a table of at most one row has no cuts.
        """
        if not order_by:
            raise ValueError("An order needs at least one column.")
        keyed = df.select(_key(order_by).alias(_KEY))
        key_type = keyed.schema[_KEY].dataType
        rows = keyed.count()
        # The same plan at every size: as many blocks as tasks can run, more where rows ask for it.
        parallel = max(2, df.sparkSession.sparkContext.defaultParallelism)
        blocks = min(max(math.ceil(rows / rows_per_block), parallel), MAX_BLOCKS, rows)
        if blocks <= 1:
            return cls(tuple(order_by), key_type)
        wanted = min(blocks * 100, _MAX_SAMPLE)
        drawn = keyed if wanted >= rows else keyed.sample(False, wanted / rows, seed=17)
        ordered = drawn.agg(F.sort_array(F.collect_list(_KEY)).alias("keys"))

        def picked(i: Column) -> Column:
            """The cut key, the sampled key before it, and those ``_DEPTHS`` places before it, all as text."""
            place = F.floor(i.cast("long") * F.size("keys") / F.lit(blocks)).cast("int")
            key = {f"b{depth}": F.get("keys", place - depth) for depth in (0, 1, *_DEPTHS)}
            return F.struct(place.alias("place"), *[F.to_json(value, _JSON).alias(name) for name, value in key.items()])

        found = ordered.select(F.transform(F.sequence(F.lit(1), F.lit(blocks - 1)), picked)).first()[0]
        cuts: list[str] = []
        spare: dict[int, int] = {}
        bands: list[list[str | None]] = []
        start = 0
        for key in found:
            if key.b0 is None:
                continue
            if cuts and cuts[-1] == key.b0:
                spare[len(cuts)] = spare.get(len(cuts), 0) + 1
                start = key.place + 1
                continue
            alone = len(cuts) in spare
            if alone:
                bands.append([None] * len(_DEPTHS))
            # Sampled keys are rows, so at least `depth` rows of this block lie at or above the one `depth`
            # places before its end.  That is not known where either end falls among equal keys.
            known = key.b1 is not None and key.b1 != key.b0
            reached = [key[f"b{depth}"] if known and key.place - depth >= start else None for depth in _DEPTHS]
            bands.append([None if alone and text == cuts[-1] else text for text in reached])
            cuts.append(key.b0)
            start = key.place
        if len(cuts) in spare:
            bands.append([None] * len(_DEPTHS))
        return cls(tuple(order_by), key_type, tuple(cuts), tuple(spare), tuple(spare.values()), tuple(zip(*bands)))

    def collapsed(self) -> OrderedBlocks:
        """The same cuts for a frame from ``collapse_copies``, which has no heavy blocks."""
        return replace(self, spare=())

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the block of every row: the number of cut keys at or below its key, where a key with a block to
        itself counts once more for the keys above it.

        A bisection, one projection per level so that each level is evaluated once and compiled
        into the scan's stage.  The level with stride ``s`` only ever looks at every 2s-th cut.
        """
        out = df.withColumn(_KEY, _key(self.order_by)).withColumn(BLOCK, F.lit(0))
        for bit in reversed(range(len(self.cuts).bit_length())):
            stride = 1 << bit
            level = f"[{','.join(self.cuts[stride - 1 :: 2 * stride])}]"
            table = F.from_json(F.lit(level), T.ArrayType(self.key_type), _JSON)
            passed = F.get(table, F.shiftright(BLOCK, bit + 1)) <= F.col(_KEY)
            out = out.withColumn(BLOCK, F.col(BLOCK) + F.when(passed, stride).otherwise(0))
        if self.split:
            alone = set(self.split)
            before = _constants([bisect_left(self.split, cut) for cut in range(len(self.cuts) + 1)])
            own = ",".join(["null", *[text if cut in alone else "null" for cut, text in enumerate(self.cuts, 1)]])
            key = F.get(F.from_json(F.lit(f"[{own}]"), T.ArrayType(self.key_type), _JSON), F.col(BLOCK))
            above = F.when(key < F.col(_KEY), 1).otherwise(0)
            out = out.withColumn(BLOCK, F.col(BLOCK) + F.get(before, F.col(BLOCK)) + above)
        return out.drop(_KEY)

    def _near_end(self, depth: int) -> Column:
        """Rows of all blocks but the last, that may be among the ``depth`` last ones of their block."""
        inside = F.col(BLOCK) < self.blocks - 1
        reach = next((number for number, known in enumerate(_DEPTHS) if known >= depth), None)
        if reach is None or not self.sampled:
            return inside
        starts = f"[{','.join(text or 'null' for text in self.sampled[reach])}]"
        start = F.get(F.from_json(F.lit(starts), T.ArrayType(self.key_type), _JSON), F.col(BLOCK))
        return inside & F.coalesce(start <= _key(self.order_by), F.lit(True))

    def _halo(self, blocked: DataFrame, depth: int, columns: Sequence[str]) -> DataFrame:
        """For every block, the ``depth`` rows that precede it, as rows of that block.

        Never more than ``depth`` rows per block enter the one unpartitioned window here.
        """
        newest = Window.partitionBy(BLOCK).orderBy(*[F.col(name).desc() for name in self.order_by])
        tails = (
            _settled(blocked)
            .where(self._near_end(depth))
            .select(BLOCK, *dict.fromkeys([*self.order_by, *columns]))
            .withColumn(_RANK, F.row_number().over(newest))
            .where(F.col(_RANK) <= depth)
        )
        # The row `depth` places further on lies in the last block that still sees this row.
        sees = F.lead(BLOCK, depth, self.blocks - 1).over(Window.orderBy(*self.order_by))
        return (
            tails.withColumn(_RANK, sees)
            .where(F.col(_RANK) > F.col(BLOCK))
            .withColumn(BLOCK, F.explode(F.sequence(F.col(BLOCK) + 1, F.col(_RANK))))
            .drop(_RANK)
        )

    def lag(self, df: DataFrame, lags: Mapping[str, tuple[str, int]], keep_blocks: bool = False) -> DataFrame:
        """Add ``{new: (column, offset)}`` as the value ``offset`` rows earlier in the order.

        The result is in order within and across its partitions, so writing it gives files in order.

        Each copy of a row repeated more than ``max offset`` times has its own values at every offset, so
        of a heavy block only the first copies pass through the window.  The rest travel as (row, copies)
        in chunks, dealt over the spare partitions that follow the block, and grow to rows there.
        """
        depth = max((offset for _, offset in lags.values()), default=0)
        if depth < 1 or min(offset for _, offset in lags.values()) < 1:
            raise ValueError("Lag offsets must be at least 1.")
        main = self.attach(df)
        part, rest = BLOCK, None
        if self.heavy:
            blocked = _settled(main)
            in_heavy = F.col(BLOCK).isin(sorted(self.heavy))
            counted = collapse_copies(blocked.where(in_heavy))
            few = _repeat(counted.withColumn(COPIES, F.least(COPIES, F.lit(depth).cast("long"))))
            main = blocked.where(~in_heavy).unionByName(few)
            rest = _in_chunks(counted.where(F.col(COPIES) > depth).withColumn(COPIES, F.col(COPIES) - depth))
        if self.cuts:
            halo = self._halo(main, depth, sorted({column for column, _ in lags.values()}))
            main = main.withColumn(_HALO, F.lit(False)).unionByName(
                halo.withColumn(_HALO, F.lit(True)), allowMissingColumns=True
            )
            parts = self.blocks
            if rest is not None:
                part = _PART
                # Every block comes after the spare partitions of all heavy blocks before it.
                places = [0]
                for block in range(self.blocks):
                    places.append(places[-1] + 1 + self.heavy.get(block, 0))
                spare = _constants([self.heavy.get(block, 0) for block in range(self.blocks)])
                parts, place = places.pop(), F.get(_constants(places), F.col(BLOCK))
                dealt = (place + 1 + F.col(_RANK) % F.get(spare, F.col(BLOCK))).cast("int")
                main = main.withColumn(part, place).unionByName(
                    rest.withColumn(part, dealt).drop(_RANK).withColumn(_HALO, F.lit(False)), allowMissingColumns=True
                )
            # Partition i is block i: one block per task, and partitions follow the order.
            main = main.repartitionById(parts, part)
        window = Window.partitionBy(part).orderBy(*self.order_by)
        values = {new: F.lag(column, offset).over(window) for new, (column, offset) in lags.items()}
        lagged = main.withColumns(values)
        if rest is not None:
            alone = {new: F.when(F.col(COPIES).isNull(), F.col(new)).otherwise(F.col(old)) for new, (old, _) in lags.items()}
            copies = F.sequence(F.lit(1).cast("long"), F.coalesce(COPIES, F.lit(1).cast("long")))
            lagged = lagged.where(~F.col(_HALO)).withColumns(alone)
            lagged = lagged.withColumn(_RANK, F.explode(copies)).drop(_HALO, _RANK, COPIES, part)
        elif self.cuts:
            lagged = lagged.where(~F.col(_HALO)).drop(_HALO)
        return lagged if keep_blocks else lagged.drop(BLOCK)

    def last_seen(self, blocked: DataFrame, column: str, out: str) -> DataFrame:
        """Last non-null ``column`` at or before each row; ``blocked`` comes from ``lag(keep_blocks=True)``.

        Blocks are scanned apart; each then takes the last value of the blocks before it from a
        table of one row per block.  Copies of a row would stay together here, so frames with heavy
        blocks have to be collapsed first.
        """
        if self.heavy:
            raise ValueError("Collapse the copies in this frame first.")
        window = Window.partitionBy(BLOCK).orderBy(*self.order_by).rowsBetween(Window.unboundedPreceding, 0)
        scanned = blocked.withColumn(out, F.last(column, ignorenulls=True).over(window))
        if not self.cuts:
            return scanned
        dated = F.struct(*self.order_by, F.col(column).alias("_value"))
        closing = F.max(F.when(F.col(column).isNotNull(), dated))["_value"]
        earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            blocked.groupBy(BLOCK)
            .agg(closing.alias("_closing"))
            .select(BLOCK, F.last("_closing", ignorenulls=True).over(earlier).alias("_carried"))
        )
        # One row per block, and `fit` fixes the number of blocks.
        return (
            scanned.join(F.broadcast(carried), BLOCK, "left")
            .withColumn(out, F.coalesce(out, "_carried"))
            .drop("_carried")
        )

    def key_at(self, df: DataFrame, ranks: Sequence[int]) -> list[Column]:
        """Keys of the rows at the given 1-based ranks, exactly, as constants for ``up_to``.

        Per-block counts locate each rank; only distinct keys of the blocks hit are ranked.
        """
        blocked = self.attach(df.select(*self.order_by))
        sizes = {row[BLOCK]: row["count"] for row in blocked.groupBy(BLOCK).count().collect()}
        places: dict[int, tuple[int, int]] = {}
        for rank in ranks:
            before = 0
            for block in sorted(sizes):
                if before < rank <= before + sizes[block]:
                    places[rank] = (block, rank - before)
                before += sizes[block]
            if rank not in places:
                raise ValueError(f"Rank {rank} is outside the {before} rows.")
        running = Window.partitionBy(BLOCK).orderBy(*self.order_by).rowsBetween(Window.unboundedPreceding, 0)
        counted = (
            blocked.where(F.col(BLOCK).isin(sorted({block for block, _ in places.values()})))
            .groupBy(BLOCK, *self.order_by)
            .agg(F.count(F.lit(1)).alias(COPIES))
            .withColumn("_upto", F.sum(COPIES).over(running))
        )
        covers = [
            F.when(
                (F.col(BLOCK) == block) & F.col("_upto").between(inside, F.lit(inside - 1) + F.col(COPIES)),
                F.lit(rank).cast("long"),
            )
            for rank, (block, inside) in places.items()
        ]
        found = counted.withColumn(_RANK, F.explode(F.array_compact(F.array(*covers))))
        texts = {row[0]: row[1] for row in found.select(_RANK, F.to_json(_key(self.order_by), _JSON)).collect()}
        return [F.from_json(F.lit(texts[rank]), self.key_type, _JSON) for rank in ranks]

    def up_to(self, key: Column) -> Column:
        """Whether a row comes at or before ``key`` in the order."""
        return _key(self.order_by) <= key


def _constants(numbers: Sequence[int]) -> Column:
    return F.from_json(F.lit(str(list(numbers))), T.ArrayType(T.IntegerType()))


def _settled(blocked: DataFrame) -> DataFrame:
    """The same rows, with blocks that later filters read instead of working them out again.

    A filter moves below projections, where every level of ``attach`` would be spelled out within the next;
    it does not move below a generator.
    """
    return blocked.withColumn(BLOCK, F.explode(F.array(BLOCK)))


def _repeat(counted: DataFrame) -> DataFrame:
    numbers = F.sequence(F.lit(1).cast("long"), F.col(COPIES))
    return counted.withColumn(_RANK, F.explode(numbers)).drop(_RANK, COPIES)


def collapse_copies(df: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of its copies; merged on the map side first."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def restore_copies(counted: DataFrame) -> DataFrame:
    """Undo ``collapse_copies``; chunks of a long run are dealt over tasks before they grow."""
    columns = [name for name in counted.columns if name != COPIES]
    return _repeat(_in_chunks(counted).repartition(*columns, _RANK).drop(_RANK))


def _in_chunks(counted: DataFrame) -> DataFrame:
    """Rows with many copies as several rows with at most ``_EXPAND_CHUNK`` each, numbered from 0."""
    chunk = F.lit(_EXPAND_CHUNK).cast("long")
    last = F.ceil(F.col(COPIES) / chunk).cast("long") - 1
    return counted.withColumn(_RANK, F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn(
        COPIES, F.least(chunk, F.col(COPIES) - F.col(_RANK) * chunk)
    )


def total_order(df: DataFrame, order_by: Sequence[str], tiebreak: Sequence[str] | None = None) -> list[str]:
    """``order_by`` made total: by the given unique columns, else by all remaining columns.

    Columns that have no order, such as maps, take no part.
    """
    sortable = [field.name for field in df.schema if not re.search(r"\b(map<|variant)", field.dataType.simpleString())]
    extra = [name for name in sortable if name not in order_by] if tiebreak is None else list(tiebreak)
    return [*order_by, *extra]


def global_lag(
    df: DataFrame,
    order_by: Sequence[str],
    lags: Mapping[str, tuple[str, int]],
    tiebreak: Sequence[str] | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``LAG(column, offset) OVER (ORDER BY order_by)`` for all rows of ``df``.

    ``tiebreak`` names columns that make the order unique.  Without it all other columns take
    part, so only rows equal in every column stay tied and the result is still determined.
    The result is in order across its partitions.  ``df`` is read three times (count, cut keys, halo) before the main pass: hand in a scan or
    a stored table, not an expensive plan.  Nulls in order columns sort first.
    """
    blocks = OrderedBlocks.fit(df, total_order(df, order_by, tiebreak), rows_per_block)
    return blocks.lag(df, lags)
