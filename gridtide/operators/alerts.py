"""Alerts on a condition that has to hold for some time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.temporal import duration
from gridtide.operators.ordered import ROWS_PER_BLOCK, OrderedBlocks, collapse_copies, restore_copies

PENDING, FIRING = "pending", "firing"


def is_above(value: Column, threshold: float) -> Column:
    """``value > threshold``; NaN is not above anything."""
    return (value > threshold) & ~F.isnan(value)


def sustained(
    samples: DataFrame,
    series: Sequence[str],
    threshold: float,
    hold: str,
    ts: str = "ts",
    value: str = "value",
    max_gap: str | None = None,
    tiebreak: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Samples above the threshold with the start of their unbroken run and the alert state.

    A run ends at a sample of the series that is not above the threshold or, with ``max_gap``,
    after a longer silence.  The state is ``firing`` once the run has lasted ``hold``.  Runs are
    found on one order over (series, time) cut into blocks, so neither a long run nor a crowded
    series has to fit in a task.  ``samples`` is read several times: hand in a stored table.
    """
    needed = samples.select(*dict.fromkeys([*series, ts, value, *tiebreak]))
    order = [*series, ts, *(tiebreak or [value])]
    blocks = OrderedBlocks.fit(needed, order, rows_per_block)
    copied = bool(blocks.heavy)
    if copied:
        needed, blocks = collapse_copies(needed), blocks.collapsed()
    before = {f"_before_{name}": (name, 1) for name in (*series, ts, value)}
    lagged = blocks.lag(needed, before, keep_blocks=True)
    goes_on = F.coalesce(is_above(F.col(f"_before_{value}"), threshold), F.lit(False))
    for name in series:
        goes_on = goes_on & F.col(f"_before_{name}").eqNullSafe(F.col(name))
    if max_gap is not None:
        goes_on = goes_on & (F.col(ts) <= F.col(f"_before_{ts}") + duration(max_gap))
    above = is_above(F.col(value), threshold)
    starts = lagged.withColumn("_start", F.when(above & ~goes_on, F.col(ts)))
    runs = blocks.last_seen(starts, "_start", "active_since")
    fires = F.col(ts) >= F.col("active_since") + duration(hold)
    found = runs.where(above)
    if copied:
        found = restore_copies(found)
    return found.select(*series, ts, value, "active_since", F.when(fires, FIRING).otherwise(PENDING).alias("state"))


def firing_count(alerts: DataFrame, ts: str = "ts") -> DataFrame:
    """Number of firing alerts per time; times with none give no row."""
    return alerts.where(F.col("state") == FIRING).groupBy(ts).agg(F.count(F.lit(1)).alias("firing"))
