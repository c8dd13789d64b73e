"""Files, tables and external sources."""

from types import SimpleNamespace

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from gridtide.operators.wide import stage
from gridtide.session import scratch_path, scratch_root
from gridtide.sources import jdbc, tables
from gridtide.sources.files import count_rows, newest_version, read_csv, read_parquet, replace_parquet, write_parquet
from gridtide.sources.spec import SourceSpec, power_load_source

COLUMNS = (("measured_at", "time"), ("megawatts", "load_actual"))


def source(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return SourceSpec("load", str(path), "measured_at", COLUMNS)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("infer", [False, True])
@pytest.mark.parametrize("stamp", ["2031-07-05 05:00:00", "2031-07-05T05:00:00Z"])
def test_times_are_utc(spark, tmp_path, zone, infer, stamp):
    spec = source(tmp_path, f"other,measured_at,megawatts\nx,{stamp},10\ny,,11\n")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = stage(read_csv(spark, spec, infer), spec).select(F.col("time").cast("string"), "load_actual").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(row) for row in rows] == [("2031-07-05 05:00:00", 10)]


def test_csv_reads_only_mapped_columns(spark, tmp_path):
    spec = source(tmp_path, "a,measured_at,b,megawatts\n1,2031-07-05 00:00:00,not a number,10\n")
    staged = stage(read_csv(spark, spec), spec)
    assert "ReadSchema: struct<measured_at:timestamp,megawatts:double>" in plan_of(staged)


def test_csv_errors(spark, tmp_path):
    with pytest.raises(ValueError, match=r"lacks the columns \['megawatts'\]"):
        read_csv(spark, source(tmp_path, "measured_at,val\n2031-07-05 00:00:00,10\n"))
    bad = source(tmp_path, "measured_at,megawatts\n2031-07-05 00:00:00,ten\n", "bad.csv")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        stage(read_csv(spark, bad), bad).collect()


def test_inferred_columns_get_the_declared_types(spark, tmp_path):
    """Whole numbers, an empty column and a word among numbers."""
    spec = source(tmp_path, "measured_at,megawatts\n2031-07-05 00:00:00,10\n2031-07-05 01:00:00,\n")
    staged = stage(read_csv(spark, spec, infer=True), spec)
    assert dict(staged.dtypes)["load_actual"] == "double"
    assert sorted(row.load_actual or 0 for row in staged.collect()) == [0, 10.0]
    empty = source(tmp_path, "measured_at,megawatts\n2031-07-05 00:00:00,\n", "empty.csv")
    assert stage(read_csv(spark, empty, infer=True), empty).first().load_actual is None
    bad = source(tmp_path, "measured_at,megawatts\n2031-07-05 00:00:00,10\n2031-07-05 01:00:00,n/a\n", "bad.csv")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(read_csv(spark, bad, infer=True), bad).collect()


def test_spec():
    spec = power_load_source("raw.csv")
    assert [clean for _, clean in spec.columns] == [
        *("time", "load_actual", "load_forecast", "solar_actual", "wind_actual", "wind_onshore", "wind_offshore")
    ]
    entry = {"raw_file": "f", "timestamp": "t", "columns": [{"raw": "t", "clean": "time"}], "frequency": "daily"}
    assert SourceSpec.from_mapping("s", entry) == SourceSpec("s", "f", "t", (("t", "time"),), "daily")
    with pytest.raises(ValueError, match="timestamp"):
        SourceSpec("s", "f", "t", (("u", "time"),))
    with pytest.raises(ValueError, match="twice"):
        SourceSpec("s", "f", "t", (("t", "time"), ("u", "time")))


def test_parquet_export_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_parquet(spark.range(100), path) == 100
    assert write_parquet(spark.range(40).repartition(5), path, sort_by=["id"]) == 40
    assert read_parquet(spark, path).count() == 40
    assert all(name.endswith(".zstd.parquet") for name in map(str, (tmp_path / "out").glob("part-*")))
    assert write_parquet(spark.range(0), path) == 0
    with pytest.raises(FileNotFoundError, match="comes from ingestion"):
        read_parquet(spark, str(tmp_path / "none"), "ingestion")


def test_tables(spark, tmp_path):
    tables.replace_table(spark.range(5), "gt_table", str(tmp_path / "t"))
    tables.replace_table(spark.range(7).withColumn("x", F.lit(1)), "gt_table", str(tmp_path / "t"))
    assert tables.table_stats(spark, "gt_table") == {"rows": 7, "columns": 2}
    tables.drop_table(spark, "gt_table")
    tables.drop_table(spark, "gt_table")
    assert not spark.catalog.tableExists("gt_table")
    for name in ("1x", "a-b", "x;drop", "ä", ""):
        with pytest.raises(ValueError, match="plain table name"):
            tables.drop_table(spark, name)


def _broken(df):
    return df.where(F.when(F.col("id") == 3, F.raise_error(F.lit("planted fault"))).isNull())


def test_a_failed_replacement_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "it's")
    tables.replace_table(spark.range(5), "gt_kept", path)
    replace_parquet(spark.range(9), f"{path}/plain")
    with pytest.raises(Exception, match="planted fault"):
        tables.replace_table(_broken(spark.range(9).withColumn("x", F.lit(1))), "gt_kept", path)
    with pytest.raises(Exception, match="planted fault"):
        replace_parquet(_broken(spark.range(4)), f"{path}/plain")
    assert spark.table("gt_kept").columns == ["id"]
    assert tables.table_stats(spark, "gt_kept") == {"rows": 5, "columns": 1}
    assert read_parquet(spark, f"{path}/plain").count() == 9
    assert len(list((tmp_path / "it's" / "plain").iterdir())) == 1
    tables.drop_table(spark, "gt_kept")


def test_a_version_without_its_mark_is_not_read(spark, tmp_path):
    """As a lost driver leaves it; the next replacements clear it away."""
    path = str(tmp_path / "t")
    replace_parquet(spark.range(9), path)
    lost = tmp_path / "t" / "version-000000002-00000000"
    write_parquet(spark.range(3), str(lost))
    (lost / "_SUCCESS").unlink()
    assert read_parquet(spark, path).count() == 9
    for rows in (5, 4):
        assert replace_parquet(read_parquet(spark, path).limit(rows), path) == rows
    assert not lost.exists() and len(list((tmp_path / "t").iterdir())) == 2
    assert newest_version(spark, path).endswith(sorted(part.name for part in (tmp_path / "t").iterdir())[-1])


def test_a_table_may_read_itself_and_running_readers_keep_their_files(spark, tmp_path):
    tables.replace_table(spark.range(8), "gt_self", str(tmp_path / "t"))
    early = spark.table("gt_self")
    tables.replace_table(early.where("id % 2 = 0"), "gt_self", str(tmp_path / "t"))
    assert [early.count(), spark.table("gt_self").count()] == [8, 4]
    tables.drop_table(spark, "gt_self")


def test_a_table_in_the_warehouse_goes_with_its_files(spark):
    tables.replace_table(spark.range(8), "gt_own")
    root = tables._made_here(spark, "gt_own")["root"]
    tables.drop_table(spark, "gt_own")
    assert not spark.catalog.tableExists("gt_own") and newest_version(spark, root) is None


def test_rows_are_counted_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(spark.range(50).withColumn("k", F.col("id") % 3), path, partition_by=["k"])
    counted = count_rows(spark, path)
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    assert counted.first()["rows"] == 50
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sql_and_bounded_fetch(spark):
    df = tables.run_sql(spark, "SELECT id FROM {t} WHERE id < :top", {"t": spark.range(10)}, top=3)
    assert list(tables.fetch_frame(df, max_rows=3)["id"]) == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 2"):
        tables.fetch_frame(df, max_rows=2)


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x:y", "t", 1)
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000"}
    split = jdbc.jdbc_options("u", "t", 9, "d.D", "id", (0, 90))
    assert split["driver"] == "d.D" and split["numPartitions"] == "9" and split["upperBound"] == "90"
    with pytest.raises(ValueError, match="bounds"):
        jdbc.jdbc_options("u", "t", 1, partition_column="id")


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_path(spark, "x") != scratch_path(spark, "x") and scratch_path(spark, "x").startswith(f"{root}/x-")


@pytest.mark.parametrize("master", ["local[8]", "spark://host:7077"])
def test_scratch_folder_without_the_setting(master):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master=master)
    )
    if master.startswith("local"):
        assert scratch_root(session) == scratch_root(session)
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(session)
