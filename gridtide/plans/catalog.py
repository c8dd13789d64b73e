"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.functions.labels import label, label_is, label_is_not, label_matches, label_matches_not
from gridtide.functions.temporal import day_of, hour_of_day, month_text
from gridtide.operators import alerts, marts, metrics, quality, wide
from gridtide.plans.event_tables import EVENTS, MONTH, events, raw_load, samples, staged_load, write_raw_csv
from gridtide.plans.stages import Layout, run_all
from gridtide.plans.training import TrainingSpec, chronological_split, train
from gridtide.session import scratch_path
from gridtide.sources.files import count_rows, read_csv, read_parquet, replace_parquet, write_parquet
from gridtide.sources.tables import drop_table, replace_table, run_sql, table_stats
from gridtide.streaming import rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _rounded(*names: str) -> dict[str, Column]:
    """Averages and rates, to six places: sums of doubles depend on their order."""
    return {name: F.round(name, 6) for name in names}


# Decimals of the samples, and the hour of their first day since 1970.
SCALE = 2
FIRST_HOUR = 473_352


# --- staging and features -------------------------------------------------------------------


@query
def staging_load(spark, sf_dir):
    return staged_load(spark, sf_dir).drop("event_id")


@query
def staging_untimed(spark, sf_dir):
    """Rows without a time are dropped."""
    time = EVENTS.timestamp
    raw = raw_load(events(spark, sf_dir)).withColumn(time, F.when(F.col("event_type") != "purchase", F.col(time)))
    return wide.stage(raw, EVENTS, keep=["event_id"])


@query
def features_lag(spark, sf_dir):
    return wide.features(staged_load(spark, sf_dir), tiebreak=["event_id"]).drop("event_id")


@query
def features_lag_blocks(spark, sf_dir):
    """The same with small blocks, so that small tables are cut as large ones are."""
    staged = staged_load(spark, sf_dir)
    return wide.features(staged, tiebreak=["event_id"], rows_per_block=2_000).drop("event_id")


def _crowded_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads in which all purchases are copies of one row, in the midst of the others."""
    crowd = F.col("event_type") == "purchase"
    rows = events(spark, sf_dir)
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    same = {"ts": middle, "user_id": F.lit(7).cast("long"), "value": F.lit(20.0)}
    return wide.stage(raw_load(rows.withColumns({name: F.when(crowd, one).otherwise(F.col(name)) for name, one in same.items()})), EVENTS)


@query
def features_lag_crowded(spark, sf_dir):
    """One row that repeats more often than a block holds."""
    return wide.features(_crowded_load(spark, sf_dir), rows_per_block=1_000)


@query
def stored_features_order(spark, sf_dir):
    """Whether the files of a feature table, and the rows in them, are in the order of time; copies included."""
    path = scratch_path(spark, "ordered")
    replace_parquet(wide.features(_crowded_load(spark, sf_dir), rows_per_block=1_000), path)
    stored = read_parquet(spark, path).select("time", "_metadata.file_name", "_metadata.row_index")
    # File names start with the number of the partition, so their order is that of the table.
    within = F.lag("time").over(Window.partitionBy("file_name").orderBy("row_index"))
    files = (
        stored.withColumn("disordered", (F.col("time") < within).cast("long"))
        .groupBy("file_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.coalesce("disordered", F.lit(0).cast("long"))).alias("disordered"),
            F.min("time").alias("low"),
            F.max("time").alias("high"),
        )
    )
    overlaps = F.col("low") < F.lag("high").over(Window.orderBy("file_name"))  # one row per file
    return files.withColumn("overlaps", F.coalesce(overlaps.cast("long"), F.lit(0).cast("long"))).agg(
        F.sum("row_count").alias("row_count"),
        F.min("low").alias("first_time"),
        F.max("high").alias("last_time"),
        F.sum("disordered").alias("disordered_rows"),
        F.sum("overlaps").alias("overlapping_files"),
    )


@query
def features_calendar(spark, sf_dir):
    return wide.with_calendar(staged_load(spark, sf_dir)).select("event_id", "time", "hour_of_day", "day_of_week")


@query
def forecast_error(spark, sf_dir):
    return wide.with_forecast_error(staged_load(spark, sf_dir)).select("event_id", "time", "forecast_error")


# --- marts ----------------------------------------------------------------------------------


@query
def daily_peak_struct(spark, sf_dir):
    return marts.daily_peak(staged_load(spark, sf_dir))


@query
def daily_peak_rank(spark, sf_dir):
    return marts.daily_peak_ranked(staged_load(spark, sf_dir))


@query
def daily_peak_ties(spark, sf_dir):
    """Whole-number loads tie within a day; the earliest time is reported."""
    return marts.daily_peak(staged_load(spark, sf_dir).withColumn("load_actual", F.floor("load_actual").cast("double")))


@query
def daily_peak_rank_ties(spark, sf_dir):
    whole = F.floor("load_actual").cast("double")
    return marts.daily_peak_ranked(staged_load(spark, sf_dir).withColumn("load_actual", whole))


@query
def latest_days(spark, sf_dir):
    return marts.latest_days(marts.daily_peak(staged_load(spark, sf_dir)))


@query
def latest_days_display(spark, sf_dir):
    return marts.display_days(latest_days(spark, sf_dir))


@query
def load_melt(spark, sf_dir):
    return marts.to_long(wide.with_forecast_error(staged_load(spark, sf_dir)))


@query
def series_targets(spark, sf_dir):
    long = marts.to_long(staged_load(spark, sf_dir, MONTH), marts.TARGET_SERIES)
    return marts.series_in_month(long, marts.TARGET_SERIES, MONTH)


@query
def series_features(spark, sf_dir):
    long = marts.to_long(staged_load(spark, sf_dir, MONTH), marts.FEATURE_SERIES)
    return marts.series_in_month(long, marts.FEATURE_SERIES, MONTH)


@query
def month_counts(spark, sf_dir):
    month = month_text(F.col("time")).alias("month")
    return staged_load(spark, sf_dir).groupBy(month).agg(F.count(F.lit(1)).alias("row_count"))


# --- quality and scores ---------------------------------------------------------------------


@query
def quality_summary(spark, sf_dir):
    return quality.quality_summary(staged_load(spark, sf_dir)).withColumns(_rounded("avg_load_mw"))


@query
def forecast_metrics(spark, sf_dir):
    return quality.forecast_scores(staged_load(spark, sf_dir)).withColumns(_rounded("mae", "rmse"))


@query
def forecast_metrics_by_day(spark, sf_dir):
    day = day_of(F.col("time")).alias("day")
    return quality.forecast_scores(staged_load(spark, sf_dir), [day]).withColumns(_rounded("mae", "rmse"))


@query
def forecast_metrics_by_hour(spark, sf_dir):
    hour = hour_of_day(F.col("time")).alias("hour_of_day")
    return quality.forecast_scores(staged_load(spark, sf_dir), [hour]).withColumns(_rounded("mae", "rmse"))


# --- metric rules ---------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.col("labels")
    return samples(events(spark, sf_dir)).withColumns(
        {"job": label(labels, "job"), "instance": label(labels, "instance")}
    )


@query
def metric_label_filters(spark, sf_dir):
    """Equality, inequality, whole-value pattern and its negation on labels."""
    labels = F.col("labels")
    wanted = (
        label_matches(labels, "job", "click|view|err")
        & label_matches_not(labels, "instance", "1.*|7")
        & label_is_not(labels, "instance", "")
        & label_is(labels, "zone", "")
    )
    return _labelled(spark, sf_dir).where(wanted).select("event_id", "job", "instance", "value")


@query
def metric_latest(spark, sf_dir):
    return metrics.instant_values(_labelled(spark, sf_dir), ["job", "instance"], "1 hour", unique_times=True)


@query
def metric_latest_any(spark, sf_dir):
    """The form that also settles equal times."""
    return metrics.instant_values(_labelled(spark, sf_dir), ["job", "instance"], "1 hour")


@query
def metric_avg_by_label(spark, sf_dir):
    return metrics.by_label(metric_latest(spark, sf_dir), ["job"], "avg", scale=SCALE)


@query
def metric_sum_matched(spark, sf_dir):
    chosen = _labelled(spark, sf_dir).where(label_matches(F.col("labels"), "job", "click|view|purchase"))
    latest = metrics.instant_values(chosen, ["job", "instance"], "1 hour", unique_times=True)
    return metrics.by_label(latest, [], "sum").withColumns(_rounded("value"))


@query
def targets_up(spark, sf_dir):
    """An instance is up unless its newest sample is an error."""
    up = F.when(F.col("job") == "error", 0.0).otherwise(1.0)
    states = _labelled(spark, sf_dir).withColumn("value", up)
    return metrics.by_label(metrics.instant_values(states, ["instance"], "1 hour", unique_times=True), [], "sum")


@query
def metric_counter_rate(spark, sf_dir):
    rates = metrics.counter_rate(
        _labelled(spark, sf_dir), ["job"], "2 hours", "30 minutes", tiebreak=["event_id"]
    )
    return rates.withColumns(_rounded("value"))


@query
def busy_percent(spark, sf_dir):
    idle = _labelled(spark, sf_dir).where(label_matches(F.col("labels"), "job", "click|view"))
    rates = metrics.counter_rate(idle, ["job", "instance"], "2 days", "12 hours", tiebreak=["event_id"])
    return metrics.busy_percent(rates, ["instance"]).withColumns(_rounded("value"))


@query
def metric_rate_by_label(spark, sf_dir):
    """Rates of labelled series only, in percent, summed by label."""
    kept = _labelled(spark, sf_dir).where(
        label_is_not(F.col("labels"), "instance", "") & label_is_not(F.col("labels"), "job", "signup")
    )
    rates = metrics.counter_rate(kept, ["job", "instance"], "2 days", "12 hours", tiebreak=["event_id"])
    total = metrics.by_label(rates, ["job"], "sum")
    return total.withColumn("value", F.round(F.col("value") * 100, 6))


@query
def metric_topk(spark, sf_dir):
    latest = metrics.instant_values(_labelled(spark, sf_dir), ["job", "instance"], "6 hours", unique_times=True)
    return metrics.top_series(latest, 10, ["job", "instance"])


@query
def metric_ratio(spark, sf_dir):
    kept = _labelled(spark, sf_dir).where(label_matches_not(F.col("labels"), "job", "signup|error"))
    is_free, is_total = F.col("job") == "click", F.col("job") == "view"
    used = metrics.used_percent(kept, ["instance"], "1 day", is_free, is_total, unique_times=True)
    return used.withColumns(_rounded("value"))


@query
def alert_sustained(spark, sf_dir):
    return alerts.sustained(_labelled(spark, sf_dir), ["job"], 20.0, "30 minutes", tiebreak=["event_id"])


def _hourly_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorded rule: stored, because the alert on it reads it several times."""
    seen = metrics.instant_of("ts", "1 hour").alias(metrics.INSTANT)
    means = _labelled(spark, sf_dir).groupBy("job", seen).agg(metrics.aggregate("avg", scale=SCALE))
    path = scratch_path(spark, "hourly")
    write_parquet(means, path)
    return read_parquet(spark, path)


@query
def alert_instants(spark, sf_dir):
    """Alert on hourly averages; a missing hour ends a run."""
    return alerts.sustained(
        _hourly_average(spark, sf_dir), ["job"], 45.0, "2 hours", ts=metrics.INSTANT, max_gap="1 hour"
    )


@query
def alert_busy(spark, sf_dir):
    """Rates, their average by instance, the busy share, and an alert once it has held."""
    path = scratch_path(spark, "busy")
    write_parquet(busy_percent(spark, sf_dir), path)
    return alerts.sustained(
        read_parquet(spark, path), ["instance"], 99.95, "1 day", ts=metrics.INSTANT, max_gap="12 hours"
    )


@query
def alerts_firing(spark, sf_dir):
    return alerts.firing_count(alert_instants(spark, sf_dir), ts=metrics.INSTANT)


# --- streaming ------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.read_files(spark, sf_dir, events(spark, sf_dir).schema, "events.parquet")


def _scattered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as sixteen files that each span the whole time, in no order."""
    path = scratch_path(spark, "scattered")
    events(spark, sf_dir).repartition(16, F.xxhash64("event_id")).write.parquet(path)
    return rules.read_files(spark, path, events(spark, sf_dir).schema)


def _drained(spark: SparkSession, name: str, result: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    return rules.drain(result, scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint"), keys, mode)


def _rolling(stream: DataFrame, window: str, step: str) -> DataFrame:
    sampled = stream.select("ts", F.col("event_type").alias("job"), "value")
    return rules.rolling_by_label(sampled, ["job"], window, step, "10 minutes", scale=SCALE)


@query
def stream_rolling_avg(spark, sf_dir):
    rolling = _rolling(_event_stream(spark, sf_dir), "2 hours", "30 minutes")
    return _drained(spark, "rolling", rolling, ["instant", "job"])


@query
def stream_rolling_scattered(spark, sf_dir):
    rolling = _rolling(_scattered_stream(spark, sf_dir), "2 hours", "30 minutes")
    return _drained(spark, "rolling", rolling, ["instant", "job"])


@query
def stream_daily_peak(spark, sf_dir):
    staged = wide.stage(raw_load(_event_stream(spark, sf_dir)), EVENTS)
    return _drained(spark, "daily", rules.daily_peak_stream(staged, "10 minutes"), ["day"])


def _stream_alerts(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """One stream stores the hourly averages, a second finds the runs above the threshold in them."""
    hourly = _drained(spark, "hourly", _rolling(stream, "1 hour", "1 hour"), ["instant", "job"])
    recorded = scratch_path(spark, "recorded")
    write_parquet(hourly, recorded)
    followed = rules.read_files(spark, recorded, hourly.schema)
    runs = rules.runs_stream(followed, ["job"], 45.0, "1 hour", "1 hour")
    found = _drained(spark, "runs", runs, ["job", "active_since"], "complete")
    return rules.alert_states(read_parquet(spark, recorded), found, ["job"], 45.0, "2 hours", "1 hour")


@query
def stream_alerts(spark, sf_dir):
    return _stream_alerts(spark, _event_stream(spark, sf_dir))


@query
def stream_alerts_scattered(spark, sf_dir):
    return _stream_alerts(spark, _scattered_stream(spark, sf_dir))


def _samples_stream(stream: DataFrame) -> DataFrame:
    return stream.select(
        "event_id", "ts", F.col("event_type").alias("job"), F.col("user_id").cast("string").alias("instance"), "value"
    )


def _stream_rate(spark: SparkSession, stream: DataFrame, slice_length: str, late: str) -> DataFrame:
    sliced = rules.counter_slices(_samples_stream(stream), ["job"], slice_length, late, tiebreak=["event_id"])
    stored = scratch_path(spark, "slices")
    write_parquet(_drained(spark, "sliced", sliced, ["job", "slice"]), stored)
    rates = metrics.rate_of_slices(read_parquet(spark, stored), ["job"], "2 hours", "30 minutes")
    return rates.withColumns(_rounded("value"))


@query
def stream_rate(spark, sf_dir):
    return _stream_rate(spark, _event_stream(spark, sf_dir), "1 minute", "10 minutes")


@query
def stream_rate_scattered(spark, sf_dir):
    return _stream_rate(spark, _scattered_stream(spark, sf_dir), "1 minute", "10 minutes")


@query
def stream_rate_batches(spark, sf_dir):
    """In six batches whose rows overlap by some hours."""
    return _stream_rate(spark, _batched_stream(spark, events(spark, sf_dir), "ts", 6), "30 minutes", "12 hours")


@query
def stream_ratio(spark, sf_dir):
    return _stream_ratio(spark, _event_stream(spark, sf_dir))


@query
def stream_ratio_scattered(spark, sf_dir):
    return _stream_ratio(spark, _scattered_stream(spark, sf_dir))


def _stream_ratio(spark: SparkSession, stream: DataFrame) -> DataFrame:
    is_free, is_total = F.col("job") == "click", F.col("job") == "view"
    used = rules.used_percent_stream(
        _samples_stream(stream), ["instance"], "1 day", is_free, is_total, "10 minutes", unique_times=True
    )
    return _drained(spark, "ratio", used, ["instance", "instant"]).withColumns(_rounded("value"))


def _batched_stream(spark: SparkSession, rows: DataFrame, ts: str, count: int) -> DataFrame:
    """``rows`` as a stream of ``count`` batches of five days; those of odd hours come up to seven hours early."""
    hours = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / 3600)
    number = F.floor((hours + 7 * (hours % 2) - FIRST_HOUR) / 120)
    path = scratch_path(spark, "batches")
    for part in range(count):
        own = number <= 0 if part == 0 else number >= part if part == count - 1 else number == part
        rows.where(own).coalesce(1).write.parquet(f"{path}/n{part}")
    return rules.read_files(spark, f"{path}/n*", rows.schema, files_per_batch=1)


@query
def stream_alert_timely(spark, sf_dir):
    """Alerts on hourly averages as they stand after each of six batches."""
    hourly = _hourly_average(spark, sf_dir)
    stream, count = _batched_stream(spark, hourly, metrics.INSTANT, 6), 6
    found = rules.alerts_stream(stream, ["job"], 45.0, "2 hours", "1 hour", "12 hours")
    out = scratch_path(spark, "timely")
    keys = ["job", metrics.INSTANT]
    rules.drain(found, out, scratch_path(spark, "timely-checkpoint"), keys)
    after = [
        rules.results_after(spark, out, found.schema, keys, batch=number).withColumn("batch", F.lit(number))
        for number in range(count)
    ]
    return reduce(DataFrame.unionByName, after)


@query
def stream_resumed(spark, sf_dir):
    """A stream drained over the first half, drained again without new files, and over all."""
    rows, path = events(spark, sf_dir), scratch_path(spark, "resumed")
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    out, checkpoint = scratch_path(spark, "rolling"), scratch_path(spark, "rolling-checkpoint")
    drained = []
    for number, more in enumerate((early, None, ~early)):
        if more is not None:
            rows.where(more).write.parquet(f"{path}/n{number}")
        rolling = _rolling(rules.read_files(spark, f"{path}/n*", rows.schema), "2 hours", "30 minutes")
        seen, stored = rules.drain(rolling, out, checkpoint, ["instant", "job"]), scratch_path(spark, "seen")
        write_parquet(seen.withColumn("drained", F.lit(number)), stored)
        drained.append(read_parquet(spark, stored))
    return reduce(DataFrame.unionByName, drained)


# --- sources, sinks, whole jobs -------------------------------------------------------------


@query
def csv_staging(spark, sf_dir):
    spec = write_raw_csv(spark, sf_dir, scratch_path(spark, "raw"))
    return wide.stage(read_csv(spark, spec), spec)


@query
def csv_inferred(spark, sf_dir):
    spec = write_raw_csv(spark, sf_dir, scratch_path(spark, "raw"))
    return wide.stage(read_csv(spark, spec, infer=True), spec)


@query
def parquet_export(spark, sf_dir):
    """Rows counted by the write beside rows read back."""
    path = scratch_path(spark, "export")
    written = write_parquet(marts.to_long(wide.with_forecast_error(staged_load(spark, sf_dir))), path)
    stored = read_parquet(spark, path)
    return stored.groupBy("Type").agg(F.count(F.lit(1)).alias("stored")).withColumn("written", F.lit(written))


@query
def table_replace(spark, sf_dir):
    """A table replaced by a second query, its statistics, and its removal."""
    path = scratch_path(spark, "table")
    name = "gridtide_" + path.rsplit("-", 1)[1]
    replace_table(staged_load(spark, sf_dir).drop("event_id"), name, path)
    replace_table(events(spark, sf_dir).select("event_id", "value"), name, path)
    stats = table_stats(spark, name)
    drop_table(spark, name)
    return spark.createDataFrame([(stats["rows"], stats["columns"])], "row_count bigint, column_count bigint")


@query
def table_replace_failed(spark, sf_dir):
    """What a table holds after a replacement of it has failed in the middle of the write."""
    path = scratch_path(spark, "table")
    name = "gridtide_" + path.rsplit("-", 1)[1]
    kept = events(spark, sf_dir).select("event_id", "value")
    replace_table(kept, name, path)
    broken = kept.where(F.when(F.col("event_id") % 7 == 3, F.raise_error(F.lit("planted fault"))).isNull())
    try:
        replace_table(broken, name, path)
    except Exception as err:
        if "planted fault" not in str(err):
            raise
    else:
        raise RuntimeError("The planted fault did not stop the write.")
    shown = scratch_path(spark, "kept")
    write_parquet(spark.table(name), shown)
    drop_table(spark, name)
    return read_parquet(spark, shown)


@query
def table_replace_self(spark, sf_dir):
    """A table replaced twice by a query on itself."""
    path = scratch_path(spark, "table")
    name = "gridtide_" + path.rsplit("-", 1)[1]
    replace_table(events(spark, sf_dir).select("event_id", "value"), name, path)
    for _ in range(2):
        replace_table(spark.table(name).where("event_id % 3 > 0").withColumn("event_id", F.col("event_id") + 1), name, path)
    drop_table(spark, name)
    return read_parquet(spark, path)


@query
def footer_counts(spark, sf_dir):
    """Rows of the written tables from their file footers."""
    root = scratch_path(spark, "counted")
    write_parquet(events(spark, sf_dir), f"{root}/plain")
    write_parquet(events(spark, sf_dir), f"{root}/parts", partition_by=["event_type"])
    counted = [count_rows(spark, path).withColumn("layout", F.lit(path.rsplit("/", 1)[1])) for path in (f"{root}/plain", f"{root}/parts")]
    return reduce(DataFrame.unionByName, counted)


@query
def sql_text(spark, sf_dir):
    return run_sql(
        spark,
        """
        WITH daily AS (
            SELECT CAST(time AS DATE) AS day, load_actual FROM {staged} WHERE load_actual >= :least
        )
        SELECT day, COUNT(*) AS row_count, MAX(load_actual) AS peak_load FROM daily GROUP BY day
        """,
        {"staged": staged_load(spark, sf_dir)},
        least=10.0,
    )


def _stored(spark: SparkSession, sf_dir: str) -> Layout:
    """CSV through all stages into stored tables."""
    layout = Layout(scratch_path(spark, "run"))
    run_all(spark, [write_raw_csv(spark, sf_dir, f"{layout.root}/raw")], layout)
    return layout


@query
def stored_features(spark, sf_dir):
    return read_parquet(spark, _stored(spark, sf_dir).features("load"))


@query
def stored_quality(spark, sf_dir):
    return read_parquet(spark, _stored(spark, sf_dir).quality("load")).withColumns(_rounded("avg_load_mw"))


@query
def stored_latest_days(spark, sf_dir):
    return marts.latest_days(read_parquet(spark, _stored(spark, sf_dir).daily_peak("load")))


@query
def stored_series(spark, sf_dir):
    long = read_parquet(spark, _stored(spark, sf_dir).long("load"))
    return marts.series_in_month(long, marts.TARGET_SERIES, MONTH)


# --- training -------------------------------------------------------------------------------


@query
def train_split(spark, sf_dir):
    rows = staged_load(spark, sf_dir).select("time", "event_id")
    return chronological_split(rows, 0.8, folds=3, tiebreak=["event_id"])


def _trained(spark: SparkSession, sf_dir: str):
    """The declared search where the target is a step function of two declared inputs, so trees can meet it exactly."""
    kinds = events(spark, sf_dir).select("event_id", "event_type")
    shown = staged_load(spark, sf_dir).join(kinds, "event_id")
    solar, wind = ((F.col("event_type") == kind).cast("double") for kind in ("view", "click"))
    known = {"solar_actual": solar, "wind_actual": wind, "load_actual": 20.0 + 30.0 * solar + 10.0 * wind}
    return train(shown.withColumns(known), TrainingSpec())


@query
def train_holdout(spark, sf_dir):
    """Held-out error of the best point of the whole declared grid."""
    return _trained(spark, sf_dir).scores.withColumns(_rounded("mae", "rmse"))


@query
def train_grid(spark, sf_dir):
    """Cross-validated error of all points of the declared grid."""
    return _trained(spark, sf_dir).points.withColumns(_rounded("mae"))
