"""Streams fed file by file against the batch operators on the same rows."""

import pytest
from pyspark.sql import functions as F

from gridtide.operators import alerts, marts, metrics
from gridtide.streaming import rules

SCHEMA = "job string, ts timestamp_ntz, value double"


def feed(spark, folder, rows, files):
    """Files in call order; times increase from file to file."""
    size = -(-len(rows) // files)
    for number in range(files):
        part = rows[number * size : (number + 1) * size]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/n{number:02d}")
    schema = spark.createDataFrame([], SCHEMA).schema
    return rules.read_files(spark, f"{folder}/n*", schema, files_per_batch=1)


def values(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def rows(at):
    made = [("a" if i % 3 else "b", at(i * 7), float((i * 37) % 100)) for i in range(200)]
    return made + [("a", at(1400 + i * 15), 95.0) for i in range(20)]


def test_rolling_equals_batch(spark, tmp_path, rows, at):
    stream = feed(spark, tmp_path / "in", rows, 5)
    rolled = rules.rolling_by_label(stream, ["job"], "1 minute", "15 seconds", "30 seconds", count="n")
    got = rules.drain(rolled, str(tmp_path / "out"), str(tmp_path / "state"), ["instant", "job"])
    batch = (
        spark.createDataFrame(rows, SCHEMA)
        .groupBy(F.window("ts", "1 minute", "15 seconds")["end"].alias("instant"), "job")
        .agg(F.avg("value").alias("value"), F.count("value").alias("n"))
        .select("instant", "job", "value", "n")
    )
    assert values(got) == values(batch)
    with pytest.raises(ValueError, match="median"):
        rules.rolling_by_label(stream, ["job"], "1 minute", "15 seconds", "30 seconds", how="median")


def test_daily_peak_equals_batch(spark, tmp_path, at):
    rows = [("x", at(3600 * h), float((h * 7) % 24 // 2)) for h in range(24 * 4 + 5)]
    stream = feed(spark, tmp_path / "in", rows, 6).withColumnsRenamed({"ts": "time", "value": "load_actual"})
    daily = rules.daily_peak_stream(stream, "1 hour")
    got = rules.drain(daily, str(tmp_path / "out"), str(tmp_path / "state"), ["day"])
    batch = marts.daily_peak(
        spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"ts": "time", "value": "load_actual"})
    )
    assert values(got) == values(batch)


def test_rows_that_come_too_late_stop_the_job(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", sorted(rows, key=lambda row: row[1], reverse=True), 5)
    rolled = rules.rolling_by_label(stream, ["job"], "1 minute", "15 seconds", "1 second")
    with pytest.raises(rules.LateRowsDropped):
        rules.drain(rolled, str(tmp_path / "out"), str(tmp_path / "state"), ["instant", "job"])


def test_late_rows_count_whatever_a_query_remembers(spark, tmp_path, rows):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        ahead = [("a", rows[-1][1], 1.0), *rows]
        rolled = rules.rolling_by_label(feed(spark, tmp_path / "in", ahead, 8), ["job"], "1 minute", "15 seconds", "1 second")
        with pytest.raises(rules.LateRowsDropped):
            rules.drain(rolled, str(tmp_path / "out"), str(tmp_path / "state"), ["instant", "job"])
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_drain_without_new_files_gives_the_whole_result(spark, tmp_path, rows):
    def drained():
        rolled = rules.rolling_by_label(rules.read_files(spark, f"{tmp_path}/in/n*", schema), ["job"], "1 minute", "15 seconds", "30 seconds")
        return values(rules.drain(rolled, str(tmp_path / "out"), str(tmp_path / "state"), ["instant", "job"]))

    schema = spark.createDataFrame([], SCHEMA).schema
    feed(spark, tmp_path / "in", rows[:100], 2)
    first = drained()
    assert first and drained() == first
    spark.createDataFrame(rows[100:], SCHEMA).write.parquet(f"{tmp_path}/in/n99")
    assert len(drained()) > len(first) and len(drained()) > len(first)


def test_counter_slices_in_many_batches_give_the_batch_rate(spark, tmp_path, at):
    # A counter with resets, equal times, silent steps and samples that come a little late.
    rows = [("a" if i % 4 else "b", at(i * 11 // 2 + (400 if i > 150 else 0)), float((i * i) % 37)) for i in range(300)]
    rows += [("c", at(100), None), ("c", at(101), 5.0), (None, at(60), 1.0), (None, at(75), 3.0)]
    rows.sort(key=lambda row: row[1])
    rows[40:60] = reversed(rows[40:60])
    sliced = rules.counter_slices(feed(spark, tmp_path / "in", rows, 7), ["job"], "15 seconds", "5 minutes")
    slices = rules.drain(sliced, str(tmp_path / "out"), str(tmp_path / "state"), ["job", "slice"])
    got = metrics.rate_of_slices(slices, ["job"], "2 minutes", "30 seconds", rows_per_block=9)
    batch = metrics.counter_rate(spark.createDataFrame(rows, SCHEMA), ["job"], "2 minutes", "30 seconds")
    near = lambda df: sorted((str(job), instant, round(value, 9)) for job, instant, value in df.collect())
    assert near(got) == near(batch) != []


def test_a_gauge_without_its_other_leaves_no_row_and_no_state(spark, tmp_path, at):
    rows = [("free" if i % 2 else "total", at(i * 10), float(i)) for i in range(60)] + [("free", at(2000), 1.0), ("other", at(2001), 1.0)]
    stream = feed(spark, tmp_path / "in", rows, 5)
    is_free, is_total = F.col("job") == "free", F.col("job") == "total"
    used = rules.used_percent_stream(stream, [], "1 minute", is_free, is_total, "1 minute")
    got = rules.drain(used, str(tmp_path / "out"), str(tmp_path / "state"), ["instant"])
    batch = metrics.used_percent(spark.createDataFrame(rows, SCHEMA), [], "1 minute", is_free, is_total)
    assert values(got) == values(batch) != []


def test_alerts_are_known_while_they_last_and_keep_little(spark, tmp_path, at):
    step, hold, size = "15 seconds", "1 minute", 20
    instants = [(at(i * 15), "a", 90.0) for i in range(200)] + [(at(i * 15), "b", 90.0 if i % 7 else 10.0) for i in range(200)]
    instants.sort()
    schema = spark.createDataFrame([], "instant timestamp_ntz, job string, value double").schema
    for number in range(10):
        part = spark.createDataFrame(instants[number * 40 : number * 40 + 40], schema)
        part.coalesce(1).write.parquet(f"{tmp_path}/in/n{number}")
    found = rules.alerts_stream(rules.read_files(spark, f"{tmp_path}/in/n*", schema, files_per_batch=1), ["job"], 60.0, hold, step, "30 seconds")
    rules.drain(found, str(tmp_path / "out"), str(tmp_path / "state"), ["job", "instant"])
    for number in (0, 4, 9):
        so_far = spark.createDataFrame(instants[: number * 40 + 40], schema)
        batch = alerts.sustained(so_far, ["job"], 60.0, hold, ts="instant", max_gap=step).drop("active_since")
        got = rules.results_after(spark, str(tmp_path / "out"), found.schema, ["job", "instant"], batch=number)
        assert values(got.select(*batch.columns)) == values(batch)
    query = found.writeStream.outputMode("update").format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "again"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [operator.numRowsTotal for progress in query.recentProgress for operator in progress.stateOperators]
    assert max(kept) < 3 * size * 2 and kept[-1] <= kept[len(kept) // 2] + 5


@pytest.mark.parametrize("shuffled", [False, True])
def test_alerts_equal_batch_whatever_the_order(spark, tmp_path, rows, shuffled):
    step = "15 seconds"
    averaged = rules.rolling_by_label(feed(spark, tmp_path / "in", rows, 1), ["job"], step, step, "1 second")
    recorded = rules.drain(averaged, str(tmp_path / "avg"), str(tmp_path / "avg-state"), ["instant", "job"])
    instants = sorted(map(tuple, recorded.collect()))
    if shuffled:
        instants = instants[1::3] + instants[2::3] + instants[::3]
    for number in range(4):
        size = -(-len(instants) // 4)
        part = instants[number::4] if shuffled else instants[number * size :][:size]
        spark.createDataFrame(part, recorded.schema).coalesce(1).write.parquet(f"{tmp_path}/rec/n{number}")
    stored = spark.createDataFrame(instants, recorded.schema)
    followed = rules.read_files(spark, f"{tmp_path}/rec/n*", recorded.schema, files_per_batch=1)
    runs = rules.runs_stream(followed, ["job"], 60.0, step, "2 hours")
    found = rules.drain(runs, str(tmp_path / "out"), str(tmp_path / "state"), ["job", "active_since"], "complete")
    got = rules.alert_states(stored, found, ["job"], 60.0, "1 minute", step)
    batch = alerts.sustained(stored, ["job"], 60.0, "1 minute", ts=metrics.INSTANT, max_gap=step)
    assert values(got) == values(batch)
    assert got.where("state = 'firing'").count() > 2


def test_instants_and_wall_clocks_agree(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", rows, 2)
    results = []
    for kind in ("timestamp_ntz", "timestamp"):
        typed = stream.withColumn("ts", F.col("ts").cast(kind))
        rolled = rules.rolling_by_label(typed, ["job"], "1 minute", "1 minute", "30 seconds")
        results.append(values(rules.drain(rolled, str(tmp_path / kind), str(tmp_path / f"{kind}-state"), ["instant", "job"])))
    assert results[0] == results[1] != []
