"""Block-wise row-position operators against a plain window over all rows."""

import random

import pytest
from compare import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridtide.operators import ordered
from gridtide.operators.ordered import BLOCK, OrderedBlocks, global_lag, total_order

LAGS = {"one": ("v", 1), "three": ("v", 3), "key": ("t", 2)}


def plain(df, order, lags=LAGS):
    window = Window.orderBy(*order)
    return df.withColumns({new: F.lag(col, n).over(window) for new, (col, n) in lags.items()})


def same_rows(left, right):
    assert left.columns == right.columns
    key = lambda row: tuple((value is not None, value) for value in row)
    assert sorted(map(tuple, left.collect()), key=key) == sorted(map(tuple, right.collect()), key=key)


def numbers(spark, rows):
    return spark.createDataFrame(rows, "t bigint, u bigint, v double")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    times=st.lists(st.integers(0, 12), min_size=0, max_size=60),
    per_block=st.integers(2, 25),
    deep=st.integers(1, 9),
)
def test_lag_equals_plain_window(spark, times, per_block, deep):
    df = numbers(spark, [(t, u, float(u % 5)) for u, t in enumerate(times)])
    lags = {"one": ("v", 1), "deep": ("v", deep)}
    same_rows(global_lag(df, ["t"], lags, ["u"], per_block), plain(df, ["t", "u"], lags))


@pytest.mark.parametrize("per_block", [5, 40, 1000])
def test_time_with_most_rows_is_cut(spark, per_block):
    rows = [(5 if u % 3 else u, u, float(u)) for u in range(300)]
    random.Random(1).shuffle(rows)
    df = numbers(spark, rows)
    blocks = OrderedBlocks.fit(df, ["t", "u"], per_block)
    assert not blocks.heavy
    sizes = [row["count"] for row in blocks.attach(df).groupBy(BLOCK).count().collect()]
    assert max(sizes) <= 4 * max(per_block, 75)
    same_rows(global_lag(df, ["t"], LAGS, ["u"], per_block), plain(df, ["t", "u"]))


@pytest.mark.parametrize("copies", [1, 2, 3, 4, 250])
def test_equal_rows_are_collapsed(spark, copies, monkeypatch):
    monkeypatch.setattr(ordered, "_EXPAND_CHUNK", 16)
    rows = [(t, t, float(t)) for t in range(40)] + [(20, 20, 20.0)] * copies + [(3, 3, None)] * copies
    df = numbers(spark, rows).select("t", "v")
    blocks = OrderedBlocks.fit(df, ["t", "v"], 8)
    assert bool(blocks.heavy) == (copies == 250)
    same_rows(global_lag(df, ["t"], LAGS, rows_per_block=8), plain(df, ["t", "v"]))


def test_all_rows_equal(spark):
    df = numbers(spark, [(1, 1, 2.0)] * 100)
    same_rows(global_lag(df, ["t"], LAGS, rows_per_block=5), plain(df, ["t", "u", "v"]))


def test_order_types(spark, at):
    rows = [(f"s{i % 3}", at(i * 7 % 50 + i / 1e6), i * 0.1, i % 2 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double, b boolean")
    lags = {"before": ("ts", 1), "name": ("s", 4)}
    instants = df.withColumn("ts", F.col("ts").cast("timestamp"))
    decimals = df.withColumn("v", F.col("v").cast("decimal(9,4)"))
    for frame in (df, instants, decimals):
        same_rows(
            global_lag(frame, ["s", "b", "ts"], lags, ["v"], 6), plain(frame, ["s", "b", "ts", "v"], lags)
        )


def test_cut_times_keep_microseconds_in_any_zone(spark, at):
    df = spark.createDataFrame([(at(i / 1e6), float(i)) for i in range(64)], "ts timestamp_ntz, v double")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for kind in ("timestamp_ntz", "timestamp"):
            blocks = OrderedBlocks.fit(df.withColumn("ts", F.col("ts").cast(kind)), ["ts"], 4)
            attached = blocks.attach(df.withColumn("ts", F.col("ts").cast(kind)))
            assert attached.select(BLOCK).distinct().count() == blocks.blocks == 16
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_keys_sort_first(spark):
    rows = [(None if u % 4 == 0 else u % 7, u, float(u)) for u in range(80)]
    same_rows(global_lag(numbers(spark, rows), ["t"], LAGS, ["u"], 5), plain(numbers(spark, rows), ["t", "u"]))


def test_empty_table(spark):
    assert global_lag(numbers(spark, []), ["t"], LAGS, ["u"]).count() == 0


def test_offsets_have_to_be_positive(spark):
    with pytest.raises(ValueError, match="at least 1"):
        global_lag(numbers(spark, [(1, 1, 1.0)]), ["t"], {"x": ("v", 0)}, ["u"])


@pytest.mark.parametrize("per_block", [1, 3, 1000])
def test_last_seen(spark, per_block):
    rows = [(t, 0, float(t) if t in (4, 9, 60) else None) for t in range(80)]
    df = numbers(spark, rows)
    blocks = OrderedBlocks.fit(df, ["t"], per_block)
    found = blocks.last_seen(blocks.lag(df, {"x": ("v", 1)}, keep_blocks=True), "v", "seen")
    expect = df.withColumn("seen", F.last("v", ignorenulls=True).over(Window.orderBy("t")))
    same_rows(found.select("t", "seen"), expect.select("t", "seen"))


def test_key_at_is_exact(spark):
    df = numbers(spark, [(5 if u % 2 else u, u, 0.0) for u in range(200)])
    blocks = OrderedBlocks.fit(df, ["t", "u"], 9)
    for rank, key in zip((1, 77, 150, 200), blocks.key_at(df, [1, 77, 150, 200])):
        assert df.where(blocks.up_to(key)).count() == rank
    with pytest.raises(ValueError, match="outside"):
        blocks.key_at(df, [201])


def test_plan_moves_no_unbounded_data_to_one_task(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_id", "value")
    plan = plan_of(global_lag(df, ["ts"], {"x": ("value", 24)}, ["event_id"], 50))
    above_single, below_single = plan.split("SinglePartition")
    assert "WindowGroupLimit" in below_single and "(_order_rank" in below_single
    assert "WindowGroupLimit" not in above_single
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_result_is_in_order_across_partitions(spark, tmp_path):
    rows = [(u * 37 % 500, u, float(u)) for u in range(500)]
    path = str(tmp_path / "sorted")
    global_lag(numbers(spark, rows), ["t"], LAGS, ["u"], 60).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name())
    spans = stored.groupBy("file").agg(F.min("t").alias("low"), F.max("t").alias("high")).orderBy("file").collect()
    assert len(spans) == 9
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))


def test_rows_repeated_more_often_than_a_block_holds_stay_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "_EXPAND_CHUNK", 16)
    rows = [(t, t, float(t)) for t in range(60)] + [(20, 20, 20.0)] * 200 + [(59, 59, 59.0)] * 90 + [(None, 0, 0.0)] * 70
    random.Random(2).shuffle(rows)
    df = numbers(spark, rows)
    blocks = OrderedBlocks.fit(df, ["t", "u", "v"], 10)
    assert len(blocks.heavy) == 3 and sum(blocks.heavy.values()) > 15
    found = blocks.lag(df, LAGS)
    same_rows(found, plain(df, ["t", "u", "v"]))
    path = str(tmp_path / "sorted")
    found.write.parquet(path)
    stored = spark.read.parquet(path).select("t", "_metadata.file_name", "_metadata.row_index")
    times = [-1 if row.t is None else row.t for row in stored.orderBy("file_name", "row_index").collect()]
    assert times == sorted(times)
    spread = stored.where("t = 20").groupBy("file_name").count().collect()
    assert len(spread) > 4 and max(row["count"] for row in spread) <= 64


@pytest.mark.parametrize("deep", [1, 8, 20, 30])
def test_only_a_band_of_each_block_is_ranked(spark, deep):
    df = numbers(spark, [(u * 37 % 5000, u, float(u)) for u in range(5000)])
    blocks = OrderedBlocks.fit(df, ["t", "u"], 500)
    blocked = blocks.attach(df)
    near = ordered._settled(blocked).where(blocks._near_end(deep))
    sizes = [row["count"] for row in near.groupBy(BLOCK).count().collect()]
    assert len(sizes) == blocks.blocks - 1 and min(sizes) >= deep
    assert deep == 30 or max(sizes) < 400
    same_rows(blocks.lag(df, {"x": ("v", deep)}), plain(df, ["t", "u"], {"x": ("v", deep)}))


def test_filters_do_not_spell_the_levels_out(spark):
    df = spark.range(3000).select(F.col("id").alias("t"), F.lit(0).alias("v"))
    blocks = OrderedBlocks.fit(df, ["t"], 3)
    assert blocks.blocks == 1000
    plan = plan_of(ordered._settled(blocks.attach(df)).where(blocks._near_end(1)))
    assert plan.count("shiftright") == 9


def test_one_shuffle_of_the_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_id", "value")
    plan = plan_of(global_lag(df, ["ts"], {"x": ("value", 24)}, ["event_id"], 50))
    assert plan.count("shufflepartitionidpassthrough") == 1
    assert plan.count("Exchange ") == 3  # the rows, the limited tails by block, the tails in order


def test_a_map_takes_no_part_in_the_default_order(spark):
    df = spark.range(40).select(F.col("id").alias("t"), F.create_map(F.lit("k"), F.col("id")).alias("m"), "id")
    assert total_order(df, ["t"]) == ["t", "id"]
    got = {row.t: row.before for row in global_lag(df, ["t"], {"before": ("id", 1)}, rows_per_block=7).collect()}
    assert got == {i: i - 1 if i else None for i in range(40)}
