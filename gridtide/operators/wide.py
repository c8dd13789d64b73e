"""Staging and feature columns of a wide series table (one row per time)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.temporal import day_of_week, hour_of_day, type_of, utc_wall_clock
from gridtide.operators.ordered import ROWS_PER_BLOCK, global_lag
from gridtide.sources.spec import SourceSpec

# Lag features as {new column: (source column, rows back)}.
LAGS = {
    "load_actual_lag_1": ("load_actual", 1),
    "load_actual_lag_24": ("load_actual", 24),
    "load_forecast_lag_1": ("load_forecast", 1),
}


def stage(raw: DataFrame, spec: SourceSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Rename the mapped columns, drop rows without a time, put times on the UTC wall clock.

    ``keep`` carries further raw columns along, such as a row id used as a tie-break.
    """
    spec.require(raw.columns)
    dtype = type_of(raw, spec.timestamp)
    mapped = [
        (utc_wall_clock(F.col(name), dtype) if name == spec.timestamp else F.col(name)).alias(clean)
        for name, clean in spec.columns
    ]
    return raw.where(F.col(spec.timestamp).isNotNull()).select(*mapped, *keep)


def with_forecast_error(df: DataFrame) -> DataFrame:
    return df.withColumn("forecast_error", F.col("load_actual") - F.col("load_forecast"))


def with_calendar(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumns({"hour_of_day": hour_of_day(F.col(time)), "day_of_week": day_of_week(F.col(time))})


def features(
    staged: DataFrame,
    time: str = "time",
    tiebreak: Sequence[str] | None = None,
    lags: Mapping[str, tuple[str, int]] = LAGS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """All feature columns.  Lags go by row position, so over a gap in time they reach further back."""
    lagged = global_lag(staged, [time], lags, tiebreak, rows_per_block)
    ready = with_calendar(with_forecast_error(lagged), time)
    leading = [name for name in ready.columns if name not in lags]
    return ready.select(*leading, *lags)
