"""Rules kept up to date over a stream.

They emit in update mode: the result of a window appears with its first rows and is replaced while more arrive,
until the watermark has passed it.  A drained source so ends with the same rows as a batch job.
Times come out on the UTC wall clock, whether they went in as instants or as zone-less times.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from threading import Condition

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from gridtide.functions.temporal import clock_text, duration, minute_of_day, seconds_of, type_of, utc_instant, utc_wall_clock
from gridtide.operators.alerts import FIRING, PENDING, is_above
from gridtide.operators.metrics import INSTANT, aggregate, grown, newest, ratio_of

_BATCH = "_batch"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, name_glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of Parquet files as they appear below ``path``.

    Without ``files_per_batch`` all files that wait are one batch, so a backlog does not depend on the
    order in which files are listed.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(path)


class LateRowsDropped(RuntimeError):
    """Rows came after the watermark had passed their window."""


class _Drops(StreamingQueryListener):
    """Late rows over all batches of each run; a query itself remembers only its last ones."""

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._changed = Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows[str(progress.runId)] += sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(self, run: str) -> int:
        """Late rows of a run that is over; its last report may still be on the way."""
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, timeout=120):
                raise RuntimeError("The reports of a finished stream did not arrive.")
        return self.rows[run]


def drain(result: DataFrame, out: str, checkpoint: str, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """Process what is available, then read the newest version of every row.  Both paths are on shared storage.

    ``keys`` name a row of the result.  Sessions cannot be updated in place: they are drained in ``complete`` mode,
    where every batch holds the whole result.  Each batch writes the rows it changed to a folder of its own, which
    a repeated batch writes again.  A later drain on the same folders goes on where this one ended and gives the whole
    result again, with or without new input.  Rows dropped as too late stop the job with ``LateRowsDropped``: they
    would be missing without a word.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{_BATCH}={number}")

    spark = result.sparkSession
    drops = _Drops()
    spark.streams.addListener(drops)
    try:
        query = (
            result.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
        dropped = drops.of(str(query.runId))
    finally:
        spark.streams.removeListener(drops)
    if dropped:
        raise LateRowsDropped(f"{dropped} rows came too late for their windows.")
    return results_after(spark, out, result.schema, keys, mode)


def results_after(
    spark: SparkSession, out: str, schema: T.StructType, keys: Sequence[str], mode: str = "update", batch: int | None = None
) -> DataFrame:
    """What the stored batches of a stream said once ``batch``, or the last one, was done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(item.getPath().getName().partition("=")[2]) for item in files.listStatus(path)] if files.exists(path) else []
    seen = [number for number in numbers if batch is None or number <= batch]
    if not seen:
        return spark.createDataFrame([], schema)
    versions = spark.read.schema(T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])).parquet(out)
    if mode == "complete":
        return versions.where(F.col(_BATCH) == max(seen)).drop(_BATCH)
    others = [name for name in schema.names if name not in keys]
    newest = versions.where(F.col(_BATCH) <= max(seen)).groupBy(*keys).agg(F.max_by(F.struct(*others), _BATCH).alias("_row"))
    return newest.select(*[F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in schema.names])


def rolling_by_label(
    samples: DataFrame,
    labels: Sequence[str],
    window: str,
    step: str,
    late: str,
    how: str = "avg",
    count: str | None = None,
    ts: str = "ts",
    value: str = "value",
    scale: int | None = None,
) -> DataFrame:
    """Aggregate of a sliding window by label, at every instant of the step.

    ``count`` names a column for the number of samples in the window; ``scale`` as in ``metrics.aggregate``.
    """
    counted = {count: F.count(value)} if count else {}
    end = utc_wall_clock(F.col("seen.end"), T.TimestampType())
    return (
        samples.withColumn("_event", utc_instant(F.col(ts), type_of(samples, ts)))
        .withWatermark("_event", late)
        .groupBy(F.window("_event", window, step).alias("seen"), *labels)
        .agg(aggregate(how, value, scale), *[col.alias(name) for name, col in counted.items()])
        .select(end.alias(INSTANT), *labels, "value", *counted)
    )


def counter_slices(
    samples: DataFrame,
    series: Sequence[str],
    slice_length: str,
    late: str,
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Slices of counters for ``metrics.rate_of_slices``, one per series and ``slice_length``; ``slice`` is its end.

    Samples of a slice wait in the state until the watermark has passed it, because one that comes late changes its
    neighbours.  A slice is summed up from them, and sums of neighbouring slices add up in any batch, so ``slice_length``
    bounds what a series keeps together: it has to divide the step of the rate, and is best a few samples long.
    """
    dtype = type_of(samples, ts)
    sample = F.struct(F.col("_event").alias("at"), *tiebreak, F.col(value).alias("value"))
    nothing = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("growth"))

    def add(done: Column, item: Column) -> Column:
        more = F.when(done["last"].isNull(), 0.0).otherwise(grown(done["last"], item["value"]))
        return F.struct(item["value"].alias("last"), (done["growth"] + more).alias("growth"))

    def wall_clock(at: Column) -> Column:
        return utc_wall_clock(at, T.TimestampType())

    first, last = F.get("listed", F.lit(0)), F.element_at("listed", -1)
    return (
        samples.where(F.col(value).isNotNull())
        .withColumn(value, F.col(value).cast("double"))
        .withColumn("_event", utc_instant(F.col(ts), dtype))
        .withWatermark("_event", late)
        .groupBy(F.window("_event", slice_length).alias("seen"), *series)
        .agg(F.sort_array(F.collect_list(sample)).alias("listed"))
        .select(
            *series,
            wall_clock(F.col("seen.end")).alias("slice"),
            wall_clock(first["at"]).alias("first_ts"),
            first["value"].alias("first_value"),
            wall_clock(last["at"]).alias("last_ts"),
            last["value"].alias("last_value"),
            F.aggregate("listed", nothing, add)["growth"].alias("growth"),
        )
    )


def used_percent_stream(
    samples: DataFrame,
    series: Sequence[str],
    step: str,
    is_free: Column,
    is_total: Column,
    late: str,
    ts: str = "ts",
    value: str = "value",
    unique_times: bool = False,
) -> DataFrame:
    """Streaming ``metrics.used_percent``: two gauges meet in one state per series and instant.

    A row comes out once both are there and changes with newer samples; the watermark ends the state of an
    instant, whether or not its other gauge has come.
    """
    free, total = (newest("_event", value, unique_times, gauge) for gauge in (is_free, is_total))
    gauges = (
        samples.where(is_free | is_total)
        .withColumn("_event", utc_instant(F.col(ts), type_of(samples, ts)))
        .withWatermark("_event", late)
        .groupBy(F.window("_event", step).alias("seen"), *series)
        .agg(free.alias("free"), total.alias("total"))
    )
    instant = utc_wall_clock(F.col("seen.end"), T.TimestampType())
    return ratio_of(gauges.withColumn(INSTANT, instant), [*series, INSTANT])


def alerts_stream(instants: DataFrame, labels: Sequence[str], threshold: float, hold: str, step: str, late: str) -> DataFrame:
    """The alert at every instant above the threshold, as soon as the instant is known: labels, instant, value, state.

    ``instants`` is a stream of one value per labels and instant of the step's grid.  An alert fires when the instants of
    the whole ``hold`` before it, and itself, are above the threshold.  They are counted in a window that slides by
    the step, so a run needs no state of its own: what an instant keeps ends ``hold`` and ``late`` after it, however long the run
    lasts, and an instant that comes late changes the alerts after it.
    """
    size = seconds_of(step)
    needed = -(-seconds_of(hold) // size) + 1
    seen = F.window("_event", f"{needed * size} seconds", f"{size} seconds").alias("seen")
    found = (
        instants.where(is_above(F.col("value"), threshold))
        .withColumn("_event", utc_instant(F.col(INSTANT), type_of(instants, INSTANT)))
        .withWatermark("_event", late)
        .groupBy(seen, *labels)
        .agg(F.count("value").alias("above"), F.max("_event").alias("last"), F.max_by("value", "_event").alias("value"))
    )
    fires = F.when(F.col("above") >= needed, FIRING).otherwise(PENDING).alias("state")
    instant = utc_wall_clock(F.col("last"), T.TimestampType()).alias(INSTANT)
    return found.where(F.col("last") == F.col("seen.end") - duration(step)).select(*labels, instant, "value", fires)


def daily_peak_stream(df: DataFrame, late: str, time: str = "time", load: str = "load_actual") -> DataFrame:
    """Streaming form of the daily peak mart; a day changes until it is over."""
    dtype = type_of(df, time)
    minute = minute_of_day(utc_wall_clock(F.col(time), dtype))
    day = F.to_date(utc_wall_clock(F.col("seen.start"), T.TimestampType()))
    return (
        df.where(F.col(load).isNotNull())
        .select(utc_instant(F.col(time), dtype).alias("_event"), F.col(load).alias("load"), minute.alias("minute"))
        .withWatermark("_event", late)
        .groupBy(F.window("_event", "1 day").alias("seen"))
        .agg(
            F.max(F.struct("load", (-F.col("minute")).alias("late"))).alias("best"),
            F.min(F.struct("load", "minute")).alias("least"),
        )
        .select(
            day.alias("day"),
            F.col("best.load").alias("peak_load"),
            clock_text(-F.col("best.late")).alias("peak_time"),
            F.col("least.load").alias("min_load"),
            clock_text(F.col("least.minute")).alias("min_time"),
        )
    )


def runs_stream(instants: DataFrame, labels: Sequence[str], threshold: float, step: str, late: str) -> DataFrame:
    """Unbroken runs of instants above the threshold: labels, ``active_since``, ``last_seen``.

    ``instants`` is a stream of one value per instant and labels.  A run is a session whose gap is just over one
    step, so instants may arrive in any order within ``late``: a late one joins the runs beside it.
    In append mode the state of a run ends when the watermark has passed it.
    """
    gap = F.lit(f"{seconds_of(step) * 1_000_000 + 1} microseconds")
    dtype = type_of(instants, INSTANT)
    return (
        instants.where(is_above(F.col("value"), threshold))
        .withColumn("_event", utc_instant(F.col(INSTANT), dtype))
        .withWatermark("_event", late)
        .groupBy(F.session_window("_event", gap).alias("run"), *labels)
        .agg(F.max("_event").alias("last"))
        .select(
            *labels,
            utc_wall_clock(F.col("run.start"), T.TimestampType()).alias("active_since"),
            utc_wall_clock(F.col("last"), T.TimestampType()).alias("last_seen"),
        )
    )


def alert_states(instants: DataFrame, runs: DataFrame, labels: Sequence[str], threshold: float, hold: str, step: str) -> DataFrame:
    """The alerts of stored instants, from the stored runs that hold them.

    A run is spread over its instants, so rows meet by equality of labels and instant.  A run that was part of a
    longer one before late instants joined them is told apart by its later start.
    """
    spread = runs.withColumn(INSTANT, F.explode(F.sequence("active_since", "last_seen", duration(step))))
    starts = spread.groupBy(*labels, INSTANT).agg(F.min("active_since").alias("active_since"))
    fires = F.col(INSTANT) >= F.col("active_since") + duration(hold)
    return (
        instants.where(is_above(F.col("value"), threshold))
        .join(starts, [*labels, INSTANT])
        .select(*labels, INSTANT, "value", "active_since", F.when(fires, FIRING).otherwise(PENDING).alias("state"))
    )
