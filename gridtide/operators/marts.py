"""Daily peak and long-format marts, and the reads made on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.numeric import with_unit
from gridtide.functions.temporal import clock_text, day_of, in_month, minute_of_day, type_of

# The series of the long table and the two groups shown from it.
SERIES = (
    "load_actual",
    "load_forecast",
    "solar_actual",
    "wind_actual",
    "wind_onshore",
    "wind_offshore",
    "forecast_error",
)
TARGET_SERIES = ("load_actual", "load_forecast")
FEATURE_SERIES = ("solar_actual", "wind_actual", "wind_onshore", "wind_offshore")
TYPE, VALUE = "Type", "Load (MW)"

# Display names of the daily table.
DISPLAY_NAMES = {
    "day": "Date",
    "peak_load": "Peak Load",
    "peak_time": "Time of Peak",
    "min_load": "Minimum Load",
    "min_time": "Time of Minimum",
}


def _measured(df: DataFrame, time: str, load: str) -> DataFrame:
    return df.where(F.col(load).isNotNull()).select(
        day_of(F.col(time)).alias("day"), F.col(load).alias("load"), minute_of_day(F.col(time)).alias("minute")
    )


def _by_minute(df: DataFrame, time: str, load: str) -> DataFrame:
    """Highest and lowest load of each minute of each day."""
    minutes = _measured(df, time, load).groupBy("day", "minute")
    return minutes.agg(F.max("load").alias("high"), F.min("load").alias("low"))


def daily_peak(df: DataFrame, time: str = "time", load: str = "load_actual") -> DataFrame:
    """Highest and lowest load of each day with their clock times; the earliest time wins a tie.

    Rows first meet in hash aggregates by day and minute, so only at most 1,440 rows of a day are compared.
    """
    best = F.max(F.struct(F.col("high").alias("load"), (-F.col("minute")).alias("late")))
    least = F.min(F.struct(F.col("low").alias("load"), "minute"))
    return (
        _by_minute(df, time, load)
        .groupBy("day")
        .agg(best.alias("best"), least.alias("least"))
        .select(
            "day",
            F.col("best.load").alias("peak_load"),
            clock_text(-F.col("best.late")).alias("peak_time"),
            F.col("least.load").alias("min_load"),
            clock_text(F.col("least.minute")).alias("min_time"),
        )
    )


def daily_peak_ranked(df: DataFrame, time: str = "time", load: str = "load_actual") -> DataFrame:
    """``daily_peak`` by ranking the rows of each day from both ends.

    One scan: both rankings are over the at most 1,440 minutes of a day, after one shuffle by day.
    """
    by_day = Window.partitionBy("day")
    ranked = _by_minute(df, time, load).withColumns(
        {
            "from_top": F.row_number().over(by_day.orderBy(F.col("high").desc(), "minute")),
            "from_bottom": F.row_number().over(by_day.orderBy("low", "minute")),
        }
    )
    peak, low = F.col("from_top") == 1, F.col("from_bottom") == 1
    return (
        ranked.where(peak | low)
        .groupBy("day")
        .agg(
            F.max(F.when(peak, F.col("high"))).alias("peak_load"),
            F.max(F.when(peak, F.col("minute"))).alias("_peak_minute"),
            F.max(F.when(low, F.col("low"))).alias("min_load"),
            F.max(F.when(low, F.col("minute"))).alias("_min_minute"),
        )
        .select(
            "day",
            "peak_load",
            clock_text(F.col("_peak_minute")).alias("peak_time"),
            "min_load",
            clock_text(F.col("_min_minute")).alias("min_time"),
        )
    )


def latest_days(mart: DataFrame, count: int = 10) -> DataFrame:
    """The newest days of the daily mart."""
    return mart.orderBy(F.col("day").desc()).limit(count)


def display_days(mart: DataFrame) -> DataFrame:
    """Daily mart with units and headings for a reader."""
    return mart.withColumns(
        {name: with_unit(F.col(name), "MW") for name in ("peak_load", "min_load") if name in mart.columns}
    ).withColumnsRenamed(DISPLAY_NAMES)


def to_long(df: DataFrame, series: Sequence[str] = SERIES, time: str = "time") -> DataFrame:
    """One row per time and series, nulls kept; a single scan whatever the number of series."""
    return df.select(time, *series).unpivot(time, list(series), TYPE, VALUE)


def series_in_month(long: DataFrame, series: Sequence[str], month: str, time: str = "time") -> DataFrame:
    """Chosen series of one month, newest first.

    On a stored long table the series picks folders and the month meets Parquet statistics; on a long
    form made in the same job neither reaches the scan if ``time`` is computed.
    """
    wanted = in_month(F.col(time), month, type_of(long, time)) & F.col(TYPE).isin(*series)
    return long.where(wanted).orderBy(F.col(time).desc(), TYPE)
