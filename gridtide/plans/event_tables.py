"""The ``events`` table seen as a wide load series and as metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.functions.temporal import duration, in_month, type_of
from gridtide.operators.wide import stage
from gridtide.sources.files import read_parquet
from gridtide.sources.spec import POWER_LOAD_COLUMNS, SourceSpec, power_load_source

EVENTS = power_load_source("events.parquet", "events")
MONTH = "2024-02"
SHIFT = "20 days"  # to span two months


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/events.parquet")


def raw_load(events: DataFrame) -> DataFrame:
    """Events under the raw column names; times are shifted."""
    value, kind = F.col("value"), F.col("event_type")
    clean = {
        "time": F.col("ts") + duration(SHIFT),
        "load_actual": F.when(kind != "signup", value),
        "load_forecast": F.col("user_id").cast("double"),
        "solar_actual": F.when(kind == "view", value),
        "wind_actual": F.when(kind == "click", value),
        "wind_onshore": F.when(kind == "error", value),
        "wind_offshore": value * 0.25,
    }
    return events.select("event_id", "event_type", *[clean[name].alias(raw) for raw, name in POWER_LOAD_COLUMNS])


def staged_load(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """The seven clean columns and ``event_id``, the tie-break; of one month if given, picked by the scan."""
    rows = events(spark, sf_dir)
    if month is not None:
        rows = rows.where(in_month(F.col("ts"), month, type_of(rows, "ts"), ahead=SHIFT))
    return stage(raw_load(rows), EVENTS, keep=["event_id"])


def samples(events: DataFrame) -> DataFrame:
    """Metric samples: labels ``job`` and ``instance``, a time and a value."""
    labels = F.create_map(
        F.lit("job"), F.col("event_type"), F.lit("instance"), F.col("user_id").cast("string")
    )
    return events.select("event_id", labels.alias("labels"), "ts", "value")


def write_raw_csv(spark: SparkSession, sf_dir: str, path: str) -> SourceSpec:
    """Store the raw table as CSV and declare it as a source."""
    raw = raw_load(events(spark, sf_dir))
    writer = raw.write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    return SourceSpec("load", path, EVENTS.timestamp, EVENTS.columns)
