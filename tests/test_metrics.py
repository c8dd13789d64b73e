"""Metric rules and alerts on hand-made samples and against brute force."""

import datetime as dt
import random

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from gridtide.functions.labels import label_is, label_is_not, label_matches, label_matches_not
from gridtide.operators import alerts, metrics

START = dt.datetime(2024, 3, 1)
SCHEMA = "job string, ts timestamp_ntz, value double"


def brute_rates(rows, window, step):
    """Rates straight from their definition, one window at a time."""
    out = {}
    for job in {row[0] for row in rows}:
        mine = sorted((ts, value) for j, ts, value in rows if j == job)
        first = min(ts for ts, _ in mine)
        instant = START + dt.timedelta(seconds=(first - START).total_seconds() // step * step)
        while instant < mine[-1][0] + dt.timedelta(seconds=window + step):
            inside = [s for s in mine if instant - dt.timedelta(seconds=window) <= s[0] < instant]
            if inside and inside[-1][0] > inside[0][0]:
                pairs = zip(inside, inside[1:])
                grown = sum(b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in pairs)
                out[job, instant] = grown / (inside[-1][0] - inside[0][0]).total_seconds()
            instant += dt.timedelta(seconds=step)
    return out


@pytest.mark.parametrize("per_block", [2, 11, 1000])
def test_rate_equals_brute_force(spark, at, per_block):
    rng = random.Random(5)
    rows = []
    for job, count in (("hot", 150), ("a", 20), ("b", 25), ("lone", 1)):
        counter = 0.0
        for second in sorted(rng.sample(range(1200), count)):
            counter = 1.0 if rng.random() < 0.1 else counter + rng.randint(0, 9)
            rows.append((job, at(second + 0.25), counter))
    rng.shuffle(rows)
    got = metrics.counter_rate(
        spark.createDataFrame(rows, SCHEMA), ["job"], "2 minutes", "15 seconds", rows_per_block=per_block
    )
    expect = brute_rates(rows, 120, 15)
    made = {(row.job, row.instant): row.value for row in got.collect()}
    assert made.keys() == expect.keys()
    assert all(made[key] == pytest.approx(expect[key], abs=1e-9) for key in expect)


def test_counter_reset_and_boundaries(spark, at):
    rows = [("a", at(0), 10.0), ("a", at(15), 40.0), ("a", at(30), 5.0), ("a", at(60), 8.0)]
    got = metrics.counter_rate(spark.createDataFrame(rows, SCHEMA), ["job"], "1 minute", "1 minute")
    # The sample at 60 s belongs to the next window, alone.
    assert [(row.instant, row.value) for row in got.collect()] == [(at(60), 35.0 / 30.0)]
    with pytest.raises(ValueError, match="multiple"):
        metrics.counter_rate(spark.createDataFrame(rows, SCHEMA), ["job"], "1 minute", "40 seconds")


def test_repeated_samples_do_not_move_a_rate(spark, at):
    once = [("a", at(0), 1.0), ("a", at(10), 4.0), ("b", at(5), 2.0)]
    many = once + [("a", at(10), 4.0)] * 200
    rate = lambda rows: metrics.counter_rate(
        spark.createDataFrame(rows, SCHEMA), ["job"], "1 minute", "1 minute", rows_per_block=10
    ).collect()
    assert rate(many) == rate(once)


def test_labels(spark):
    rows = [({"job": "node", "fs": "ext4"},), ({"job": "nodes", "fs": "tmpfs"},), ({"fs": ""},)]
    df = spark.createDataFrame(rows, "labels map<string,string>")
    labels = F.col("labels")
    count = lambda test: df.where(test).count()
    assert count(label_matches(labels, "job", "node|other")) == 1
    assert count(label_matches_not(labels, "fs", "tmpfs|overlay")) == 2
    assert count(label_is_not(labels, "fs", "")) == 2
    assert count(label_is(labels, "job", "")) == 1


def test_newest_sample_counts(spark, at):
    rows = [("a", at(1), 5.0), ("a", at(9), 3.0), ("a", at(9), 4.0), ("a", at(15), 8.0)]
    got = metrics.instant_values(spark.createDataFrame(rows, SCHEMA), ["job"], "15 seconds")
    assert sorted((row.instant, row.value) for row in got.collect()) == [(at(15), 4.0), (at(30), 8.0)]
    with pytest.raises(ValueError, match="median"):
        metrics.by_label(got, [], "median")
    fast = metrics.instant_values(spark.createDataFrame(rows, SCHEMA), ["job"], "15 seconds", unique_times=True)
    assert "HashAggregate" in plan_of(fast) and "SortAggregate" not in plan_of(fast)


@pytest.mark.parametrize("unique", [False, True])
def test_used_percent_needs_both_gauges(spark, at, unique):
    rows = [("free", at(1), 25.0), ("total", at(2), 100.0), ("free", at(70), 1.0), ("other", at(71), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    is_free, is_total = F.col("job") == "free", F.col("job") == "total"
    got = metrics.used_percent(df, [], "1 minute", is_free, is_total, unique_times=unique)
    assert [(row.instant, row.value) for row in got.collect()] == [(at(60), 75.0)]


def test_busy_percent(spark, at):
    schema = "instance string, cpu int, instant timestamp_ntz, value double"
    df = spark.createDataFrame([("a", 0, at(0), 0.9), ("a", 1, at(0), 0.7)], schema)
    assert metrics.busy_percent(df, ["instance"]).first().value == pytest.approx(20.0)


def test_top_series_limits_before_the_shuffle(spark, sf_dir, at):
    rows = [(f"s{i:02d}", at(0), float(i // 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "job string, instant timestamp_ntz, value double")
    got = metrics.top_series(df, 3, ["job"]).orderBy("rank").collect()
    assert [(row.job, row["rank"]) for row in got] == [("s28", 1), ("s29", 2), ("s26", 3)]
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("ts", "instant")
    assert "row_number(), 10, Partial" in plan_of(metrics.top_series(events, 10, ["event_type"]))


def state_rows(found):
    return [(row.job, row.ts, row.active_since, row.state) for row in found.orderBy("job", "ts").collect()]


@pytest.mark.parametrize("per_block", [1, 3, 1000])
def test_alert_just_under_and_just_over(spark, at, per_block):
    values = {0: 81.0, 60: 90.0, 119: 99.0, 125: 10.0, 130: 85.0, 250: 86.0, 251: 80.0}
    rows = [("a", at(s), v) for s, v in values.items()] + [("b", at(118), 99.0), ("b", at(260), 99.0)]
    got = alerts.sustained(spark.createDataFrame(rows, SCHEMA), ["job"], 80.0, "2 minutes", rows_per_block=per_block)
    assert state_rows(got) == [
        ("a", at(0), at(0), "pending"),
        ("a", at(60), at(0), "pending"),
        ("a", at(119), at(0), "pending"),
        ("a", at(130), at(130), "pending"),
        ("a", at(250), at(130), "firing"),
        ("b", at(118), at(118), "pending"),
        ("b", at(260), at(118), "firing"),
    ]


def test_alert_gap_ends_a_run(spark, at):
    rows = [("a", at(s), 99.0) for s in (0, 15, 45, 60)] + [("a", at(75), float("nan"))]
    got = alerts.sustained(
        spark.createDataFrame(rows, SCHEMA), ["job"], 80.0, "15 seconds", max_gap="15 seconds", rows_per_block=2
    )
    assert state_rows(got) == [
        ("a", at(0), at(0), "pending"),
        ("a", at(15), at(0), "firing"),
        ("a", at(45), at(45), "pending"),
        ("a", at(60), at(45), "firing"),
    ]
    firing = alerts.firing_count(got).orderBy("ts").collect()
    assert [(row.ts, row.firing) for row in firing] == [(at(15), 1), (at(60), 1)]


def test_one_series_holding_everything(spark, at):
    """A run far longer than a block, in a series with nearly all rows."""
    rows = [("hot", at(i), 90.0) for i in range(400)] + [("zz", at(3), 90.0)]
    got = alerts.sustained(spark.createDataFrame(rows, SCHEMA), ["job"], 80.0, "2 minutes", rows_per_block=20)
    hot = [row for row in got.collect() if row.job == "hot"]
    assert len(hot) == 400 and {row.active_since for row in hot} == {at(0)}
    assert sum(row.state == "firing" for row in hot) == 400 - 120


def test_repeated_samples_of_an_alert_are_all_reported(spark, at):
    rows = [("a", at(0), 90.0), ("a", at(200), 95.0), ("a", at(300), 10.0)] + [("a", at(130), 99.0)] * 300
    got = alerts.sustained(spark.createDataFrame(rows, SCHEMA), ["job"], 80.0, "2 minutes", rows_per_block=20)
    grouped = got.groupBy("ts", "active_since", "state").count().collect()
    counts = {(row.ts, row.active_since, row.state): row["count"] for row in grouped}
    assert counts == {
        (at(0), at(0), "pending"): 1,
        (at(130), at(0), "firing"): 300,
        (at(200), at(0), "firing"): 1,
    }
