"""Quality summary of a feature table and error scores of its forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_summary(df: DataFrame, time: str = "time", load: str = "load_actual") -> DataFrame:
    """One row: counts, time span, load statistics, missing loads (null for an empty table)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(time).alias("start_date"),
        F.max(time).alias("end_date"),
        F.avg(load).alias("avg_load_mw"),
        F.max(load).alias("max_load_mw"),
        F.min(load).alias("min_load_mw"),
        F.sum(F.when(F.col(load).isNull(), 1).otherwise(0)).alias("null_counts"),
    )


def forecast_scores(
    df: DataFrame,
    by: Sequence[Column | str] = (),
    actual: str = "load_actual",
    forecast: str = "load_forecast",
) -> DataFrame:
    """Mean absolute and root mean squared error over rows that have both values."""
    error = F.col(actual) - F.col(forecast)
    return (
        df.groupBy(*by)
        .agg(
            F.count(error).alias("scored_rows"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        )
    )
