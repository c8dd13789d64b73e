"""Staging, features, marts and summaries on hand-made tables."""

import datetime as dt

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from gridtide.functions.numeric import ieee_divide, with_unit
from gridtide.functions.temporal import in_month, seconds_of, utc_instant, utc_wall_clock
from gridtide.operators import marts, quality, wide
from gridtide.plans.catalog import QUERIES
from gridtide.plans.event_tables import staged_load
from gridtide.sources.spec import SourceSpec

WIDE = """time timestamp_ntz, load_actual double, load_forecast double, solar_actual double, wind_actual double,
    wind_onshore double, wind_offshore double"""
DAILY = "day date, peak_load double, peak_time string, min_load double, min_time string"


def table(spark, rows):
    return spark.createDataFrame([(t, load, fc, None, None, None, None) for t, load, fc in rows], WIDE)


def test_lag_goes_by_position_over_a_gap(spark):
    hours = [h for h in range(60) if h not in (10, 11, 12)]
    start = dt.datetime(2015, 1, 1)
    rows = [(start + dt.timedelta(hours=h), float(h), float(h) + 1) for h in hours]
    made = wide.features(table(spark, rows), rows_per_block=9).orderBy("time").collect()
    assert made[0].asDict().keys() == {
        *("time", "load_actual", "load_forecast", "solar_actual", "wind_actual", "wind_onshore", "wind_offshore"),
        *("forecast_error", "hour_of_day", "day_of_week"),
        *("load_actual_lag_1", "load_actual_lag_24", "load_forecast_lag_1"),
    }
    after = made[10]
    assert after.hour_of_day == 13 and after.load_actual_lag_1 == 9.0 and after.forecast_error == -1.0
    assert made[30].load_actual_lag_24 == float(hours[6])
    assert made[0].load_actual_lag_1 is None and made[23].load_actual_lag_24 is None


def test_weekday_counts_from_sunday(spark):
    days = [(dt.datetime(2024, 9, d), 1.0, 1.0) for d in range(1, 8)]
    got = wide.with_calendar(table(spark, days)).orderBy("time").select("day_of_week").collect()
    assert [row[0] for row in got] == [0, 1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("form", [marts.daily_peak, marts.daily_peak_ranked])
def test_daily_peak_edges(spark, form):
    day = dt.datetime(2024, 1, 31)
    hour = lambda h, m=0: day + dt.timedelta(hours=h, minutes=m)
    rows = [
        (hour(0), 5.0, None),
        (hour(7, 30), 9.0, None),
        (hour(20), 9.0, None),
        (hour(3), 2.0, None),
        (hour(23, 59), 2.0, None),
        (hour(5), None, None),
        (hour(24), 4.0, None),  # midnight belongs to the next day, which has this one row
        (hour(50), None, None),  # a day without loads gives no row
    ]
    got = [tuple(row) for row in form(table(spark, rows)).orderBy("day").collect()]
    assert got == [
        (dt.date(2024, 1, 31), 9.0, "07:30", 2.0, "03:00"),
        (dt.date(2024, 2, 1), 4.0, "00:00", 4.0, "00:00"),
    ]
    assert form(table(spark, [])).count() == 0


def test_long_form_keeps_nulls_and_scans_once(spark, sf_dir):
    df = wide.with_forecast_error(staged_load(spark, sf_dir))
    long = marts.to_long(df)
    assert long.count() == 7 * df.count()
    assert long.where("`Load (MW)` IS NULL").count() > 0
    assert plan_of(long).count("FileScan") == 1


def test_month_range_reaches_the_stored_scan(spark, sf_dir, tmp_path):
    marts.to_long(wide.with_forecast_error(staged_load(spark, sf_dir))).write.parquet(str(tmp_path / "long"))
    plan = plan_of(marts.series_in_month(spark.read.parquet(str(tmp_path / "long")), marts.TARGET_SERIES, "2024-02"))
    assert "GreaterThanOrEqual(time,2024-02-01T00:00)" in plan and "LessThan(time,2024-03-01T00:00)" in plan
    assert ", In(" in plan


@pytest.mark.parametrize("name", ["series_targets", "series_features"])
def test_month_range_reaches_the_scan_through_a_computed_time(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-12T00:00)" in plan and "LessThan(ts,2024-02-10T00:00)" in plan


def test_month_of_an_instant_is_a_utc_month(spark):
    rows = spark.sql("SELECT TIMESTAMP '2024-02-01 00:30:00+00:00' AS ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows.where(in_month(F.col("ts"), "2024-02", rows.schema["ts"].dataType)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_edges(spark):
    times = ["2014-12-31 23:59:59", "2015-01-01 00:00:00", "2015-12-31 23:59:59", "2016-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    kind = df.schema["t"].dataType
    months = ["2014-12", "2015-01", "2015-12", "2016-01"]
    assert [df.where(in_month(F.col("t"), month, kind)).count() for month in months] == [1, 1, 1, 1]
    with pytest.raises(ValueError, match="month"):
        in_month(F.col("t"), "2015-13", kind)


def test_latest_days_is_a_top_k(spark, sf_dir):
    plan = plan_of(marts.latest_days(marts.daily_peak(staged_load(spark, sf_dir))))
    assert "TakeOrderedAndProject" in plan


def test_daily_forms_reduce_before_the_shuffle(spark, sf_dir):
    staged = staged_load(spark, sf_dir)
    below = plan_of(marts.daily_peak(staged)).split("Exchange", 1)[1]
    assert "partial_max" in below and "partial_min" in below
    ranked = plan_of(marts.daily_peak_ranked(staged))
    before, below = ranked.rsplit("Exchange", 1)
    assert ranked.count("FileScan") == 1 and "partial_min" in below and "HashAggregate" in below
    assert "Sort" not in below


def test_display(spark):
    values = [560.21, 100.0, 15000000.0, 123456789.25, 0.0005, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(with_unit(F.col("v"), "MW"))
    got = [row[0] for row in df.collect()]
    assert got == ["560.21 MW", "100.0 MW", "15000000.0 MW", "123456789.25 MW", "0.0005 MW", None]
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 5.0, "01:00", 1.0, "02:00")], DAILY)
    assert marts.display_days(days).first().asDict() == {
        "Date": dt.date(2024, 1, 1),
        "Peak Load": "5.0 MW",
        "Time of Peak": "01:00",
        "Minimum Load": "1.0 MW",
        "Time of Minimum": "02:00",
    }


def test_quality_summary_edges(spark):
    empty = quality.quality_summary(table(spark, [])).first()
    assert empty.total_rows == 0 and empty.null_counts is None and empty.avg_load_mw is None
    missing = quality.quality_summary(table(spark, [(dt.datetime(2024, 1, 1), None, 1.0)] * 3)).first()
    assert (missing.total_rows, missing.null_counts, missing.max_load_mw) == (3, 3, None)


def test_forecast_scores(spark):
    t = dt.datetime(2024, 1, 1)
    got = quality.forecast_scores(table(spark, [(t, 3.0, 0.0), (t, 0.0, 4.0), (t, None, 1.0)])).first()
    assert (got.scored_rows, got.mae) == (2, 3.5) and got.rmse == pytest.approx(12.5**0.5)


def test_staging_drops_untimed_rows_and_reports_missing_columns(spark):
    spec = SourceSpec("load", "-", "utc", (("utc", "time"), ("x", "load_actual")))
    raw = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0), (None, 2.0)], "utc timestamp_ntz, x double")
    assert [tuple(row) for row in wide.stage(raw, spec).collect()] == [(dt.datetime(2024, 1, 1), 1.0)]
    with pytest.raises(ValueError, match=r"lacks the columns \['x'\]"):
        wide.stage(raw.drop("x"), spec)


def test_wall_clock_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        texts = [f"2020-10-25T{h:02d}:30:00.000001Z" for h in range(0, 4)] + ["1950-06-01T12:00:00.000000Z"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("i", F.col("t").cast("timestamp"))
        wall = df.select("t", "i", utc_wall_clock(F.col("i"), df.schema["i"].dataType).alias("w"))
        again = utc_instant(F.col("w"), wall.schema["w"].dataType)
        back = wall.select("t", "i", F.col("w").cast("string").alias("text"), again.alias("j"))
        for row in back.select("t", "text", (F.col("i") == F.col("j")).alias("same")).collect():
            assert row.same and row.text[:19] == row.t[:19].replace("T", " ")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers(spark):
    rows = [(1.0, 4.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double").select(ieee_divide(F.col("a"), F.col("b")).alias("r"))
    assert [str(row.r) for row in df.collect()] == ["0.25", "inf", "-inf", "nan", "None"]
    assert seconds_of("2 minutes") == 120 and seconds_of("1 Hour") == 3600
    for text in ("0 seconds", "soon", "1 month"):
        with pytest.raises(ValueError, match="duration"):
            seconds_of(text)
