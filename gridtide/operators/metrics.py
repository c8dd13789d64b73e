"""Rules over metric samples: rows of series labels, a time and a value.

Rules are evaluated at instants on a fixed grid.  An instant ``T`` of a step ``s`` sees the
samples of ``[T - s, T)``; a trailing window ``w`` sees ``[T - w, T)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.numeric import ieee_divide
from gridtide.functions.temporal import duration, seconds_between, seconds_of
from gridtide.operators.ordered import ROWS_PER_BLOCK, OrderedBlocks

INSTANT = "instant"


def instant_of(ts: str, step: str) -> Column:
    """Grid instant that first sees a sample."""
    return F.window(ts, step)["end"]


def newest(ts: str, value: str, unique_times: bool, where: Column | None = None) -> Column:
    """Value of the newest sample, of those that meet ``where``; see ``instant_values``."""
    time, sample = F.col(ts), F.struct(ts, value)
    if where is not None:
        time, sample = F.when(where, time), F.when(where, sample)
    return F.max_by(value, time) if unique_times else F.max(sample)[value]


def instant_values(
    samples: DataFrame,
    series: Sequence[str],
    step: str,
    ts: str = "ts",
    value: str = "value",
    unique_times: bool = False,
) -> DataFrame:
    """Newest sample of every series per instant; of equal times the larger value counts.

    Where a series has at most one sample per time, ``unique_times`` says so: the newest value is
    then kept in a hash aggregate, about twice as fast as the ordered comparison of pairs.
    """
    last = newest(ts, value, unique_times)
    return samples.groupBy(*series, instant_of(ts, step).alias(INSTANT)).agg(last.alias("value"))


def aggregate(how: str, value: str = "value", scale: int | None = None) -> Column:
    """``avg``, ``sum``, ``min``, ``max`` or ``count`` of the values, as ``value``.

    With ``scale``, the number of decimals that the values are declared to have, sums are exact decimals and
    so the same in every summing order; without it they are sums of doubles.
    """
    if how not in ("avg", "sum", "min", "max", "count"):
        raise ValueError(f"Unknown aggregate {how!r}.")
    if scale is None or how not in ("avg", "sum"):
        return getattr(F, how)(value).alias("value")
    total = F.sum(F.col(value).cast(f"decimal(28,{scale})")).cast("double")
    return (total / F.count(value) if how == "avg" else total).alias("value")


def by_label(
    instants: DataFrame, labels: Sequence[str], how: str, count: str | None = None, scale: int | None = None
) -> DataFrame:
    """Aggregate over series, per instant and label; ``count`` names a column for their number, ``scale`` as in ``aggregate``."""
    counted = [F.count("value").alias(count)] if count else []
    return instants.groupBy(INSTANT, *labels).agg(aggregate(how, scale=scale), *counted)


def top_series(instants: DataFrame, k: int, series: Sequence[str]) -> DataFrame:
    """The ``k`` largest series per instant; equal values go by series name.

    The rank filter is applied per task before the shuffle, so a crowded instant ships at most
    ``k`` rows per task.
    """
    largest = Window.partitionBy(INSTANT).orderBy(F.col("value").desc(), *series)
    return instants.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= k)


def used_percent(
    samples: DataFrame,
    series: Sequence[str],
    step: str,
    is_free: Column,
    is_total: Column,
    ts: str = "ts",
    value: str = "value",
    unique_times: bool = False,
) -> DataFrame:
    """``(1 - free / total) * 100`` of two gauges matched on series and instant, in one pass.

    Series or instants that lack one of the gauges give no row.  ``unique_times`` as in ``instant_values``.
    """
    free, total = (newest(ts, value, unique_times, gauge) for gauge in (is_free, is_total))
    gauges = (
        samples.where(is_free | is_total)
        .groupBy(*series, instant_of(ts, step).alias(INSTANT))
        .agg(free.alias("free"), total.alias("total"))
    )
    return ratio_of(gauges, [*series, INSTANT])


def ratio_of(gauges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``(1 - free / total) * 100`` where there are both."""
    share = ieee_divide(F.col("free"), F.col("total"))
    both = gauges.where(F.col("free").isNotNull() & F.col("total").isNotNull())
    return both.select(*keys, ((F.lit(1.0) - share) * 100).alias("value"))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    window: str,
    step: str,
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Per-second increase of each counter over a trailing window, at every instant.

    A drop between neighbouring samples is a reset, after which the counter grew by its new
    value.  The rate is the increase between the first and last sample in the window over the
    time between them; windows with fewer than two distinct times give no row.

    Neighbours come from one order over (series, time), cut into blocks wherever needed, so a
    series with most of the samples is spread like any other.  Samples are then summed per step,
    and only those sums are copied to the windows they belong to.
    """
    needed = samples.select(*dict.fromkeys([*series, ts, value, *tiebreak])).where(F.col(value).isNotNull())
    order = [*series, ts, *(tiebreak or [value])]
    before = {f"_before_{name}": (name, 1) for name in series} | {"_before_ts": (ts, 1), "_before_value": (value, 1)}
    lagged = OrderedBlocks.fit(needed, order, rows_per_block).lag(needed, before)
    alone = {"first_ts": F.col(ts), "first_value": F.col(value), "last_ts": F.col(ts), "growth": F.lit(0.0)}
    return _rate(lagged.withColumns(alone), series, window, step)


def rate_of_slices(
    slices: DataFrame, series: Sequence[str], window: str, step: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """``counter_rate`` from stretches of a series that are summed up already.

    A slice has ``first_ts``, ``first_value``, ``last_ts``, ``last_value`` and the ``growth`` between them; slices of a
    series do not overlap, and each lies within one step.
    """
    columns = [*series, "first_ts", "first_value", "last_ts", "last_value", "growth"]
    needed = slices.select(*columns)
    before = {f"_before_{name}": (name, 1) for name in series}
    before |= {"_before_ts": ("last_ts", 1), "_before_value": ("last_value", 1)}
    lagged = OrderedBlocks.fit(needed, [*series, "first_ts"], rows_per_block).lag(needed, before)
    return _rate(lagged, series, window, step)


def grown(earlier: Column, now: Column) -> Column:
    """Increase of a counter between neighbours; after a reset it grew by its new value."""
    return F.when(now >= earlier, now - earlier).otherwise(now)


def _rate(lagged: DataFrame, series: Sequence[str], window: str, step: str) -> DataFrame:
    """Rates from slices that know the end of the slice before them."""
    if seconds_of(window) % seconds_of(step):
        raise ValueError("The window has to be a multiple of the step.")
    same = F.col("_before_value").isNotNull()
    for name in series:
        same = same & F.col(f"_before_{name}").eqNullSafe(F.col(name))
    entry = grown(F.col("_before_value"), F.col("first_value"))
    stepped = lagged.select(
        *series,
        "first_ts",
        "last_ts",
        instant_of("first_ts", step).alias(INSTANT),
        F.when(same, F.col("_before_ts")).alias("_before"),
        F.when(same, entry).otherwise(F.lit(0.0)).alias("_entry"),
        "growth",
    )
    # The first slice of a step: its predecessor lies before the step.
    opens = F.col("_before").isNull() | (F.col("_before") < F.col(INSTANT) - duration(step))
    steps = stepped.groupBy(*series, INSTANT).agg(
        F.sum(F.col("_entry") + F.col("growth")).alias("_grown"),
        F.sum(F.when(opens, F.col("_entry"))).alias("_entry"),
        F.min(F.when(opens, F.col("_before"))).alias("_before"),
        F.min("first_ts").alias("_first"),
        F.max("last_ts").alias("_last"),
    )
    last_view = F.col(INSTANT) + duration(window) - duration(step)
    seen = steps.withColumn(INSTANT, F.explode(F.sequence(F.col(INSTANT), last_view, duration(step))))
    # Growth into the first sample of a window happened before that window.
    from_outside = F.col("_before").isNull() | (F.col("_before") < F.col(INSTANT) - duration(window))
    inside = F.col("_grown") - F.when(from_outside, F.col("_entry")).otherwise(F.lit(0.0))
    elapsed = seconds_between(F.min("_first"), F.max("_last"))
    return (
        seen.groupBy(*series, INSTANT)
        .agg(F.sum(inside).alias("_grown"), elapsed.alias("_elapsed"))
        .where(F.col("_elapsed") > 0)
        .select(*series, INSTANT, (F.col("_grown") / F.col("_elapsed")).alias("value"))
    )


def busy_percent(idle_rates: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``100 - avg by(labels)(idle rate) * 100``."""
    return by_label(idle_rates, labels, "avg").withColumn("value", F.lit(100.0) - F.col("value") * 100)
