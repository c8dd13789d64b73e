"""The batch stages and training, end to end on small files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridtide import __main__ as command
from gridtide.plans import stages
from gridtide.plans.training import TrainingSpec, chronological_split, save_predictions, train
from gridtide.sources.files import read_parquet
from gridtide.sources.spec import POWER_LOAD_COLUMNS, power_load_source


def raw_csv(path, hours, first=dt.datetime(2015, 1, 1)):
    lines = [",".join(["cet_timestamp", *[raw for raw, _ in POWER_LOAD_COLUMNS]])]
    for h in range(hours):
        stamp = first + dt.timedelta(hours=h)
        load = "" if h % 10 == 9 else str(40000 + 100 * (h % 24))
        lines.append(f"local,{stamp:%Y-%m-%dT%H:%M:%SZ},{load},{40000 + h},{h},{h * 2},{h},{h}")
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_whole_run(spark, tmp_path):
    layout = stages.Layout(str(tmp_path / "out"))
    sources = [
        power_load_source(raw_csv(tmp_path / "a.csv", 72), "north"),
        power_load_source(raw_csv(tmp_path / "b.csv", 30), "south"),
    ]
    for _ in range(2):  # a second run replaces the first
        done = stages.run_all(spark, sources, layout)
        assert done["ingestion"] == done["preprocessing"] == {"north": 72, "south": 30}
        assert done["marts"] == {"north": {"daily_peak": 3, "long": 504}, "south": {"daily_peak": 2, "long": 210}}
    assert len(read_parquet(spark, layout.features("north")).columns) == 13
    quality = read_parquet(spark, layout.quality("north")).first()
    assert (quality.total_rows, quality.null_counts, quality.min_load_mw) == (72, 7, 40000.0)
    peak = read_parquet(spark, layout.daily_peak("north")).orderBy("day").first()
    assert (peak.day, peak.peak_load, peak.peak_time) == (dt.date(2015, 1, 1), 42300.0, "23:00")


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda: spark)
    columns = [{"raw": raw, "clean": clean} for raw, clean in POWER_LOAD_COLUMNS]
    entry = {"raw_file": raw_csv(tmp_path / "a.csv", 48), "timestamp": "utc_timestamp", "columns": columns}
    (tmp_path / "sources.json").write_text(json.dumps({"load": entry}), encoding="utf-8")
    for name in ("ingestion", "preprocessing", "marts"):
        command.main([name, "--sources", str(tmp_path / "sources.json"), "--root", f"{tmp_path}/out/"])
    layout = stages.Layout(f"{tmp_path}/out")
    assert read_parquet(spark, layout.daily_peak("load")).count() == 2
    grid = {"n_estimators": [2], "max_depth": [2], "min_samples_split": [1], "learning_rate": [0.3]}
    sources = command.read_sources(str(tmp_path / "sources.json"))
    command.run_training(spark, sources, layout, TrainingSpec(grid=grid))
    assert read_parquet(spark, layout.scores("load")).first().scored_rows == 9


def test_one_failing_source_does_not_stop_the_rest(spark, tmp_path):
    layout = stages.Layout(str(tmp_path / "out"))
    good = power_load_source(raw_csv(tmp_path / "a.csv", 24), "ok")
    bad = power_load_source(str(tmp_path / "missing.csv"), "bad")
    with pytest.raises(RuntimeError, match="Could not stage .* as 'bad'"):
        stages.ingest_source(spark, bad, layout)
    with pytest.raises(RuntimeError, match=r"Ingestion: 1 of 2 sources not done, \['bad'\]"):
        stages.run_ingestion(spark, [bad, good], layout)
    with pytest.raises(RuntimeError, match=r"Preprocessing: 1 of 2 sources not done, \['bad'\]"):
        stages.run_preprocessing(spark, [bad, good], layout)
    with pytest.raises(RuntimeError, match=r"Marts: 1 of 2 sources not done, \['bad'\]"):
        stages.run_marts(spark, [bad, good], layout)
    assert read_parquet(spark, layout.daily_peak("ok")).count() == 1


def test_stage_needs_the_stage_before(spark, tmp_path):
    layout, source = stages.Layout(str(tmp_path)), power_load_source("x.csv")
    with pytest.raises(FileNotFoundError, match="comes from ingestion"):
        stages.run_preprocessing(spark, [source], layout)
    with pytest.raises(FileNotFoundError, match="comes from preprocessing"):
        stages.run_marts(spark, [source], layout)
    with pytest.raises(RuntimeError, match="Could not build the features of 'load'"):
        stages.prepare_source(spark, source, layout)


def test_split_is_chronological_and_exact(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("time"), "id")
    parted = chronological_split(df, 0.8, folds=3, rows_per_block=60)
    spans = parted.groupBy("part", "fold").agg(F.min("time"), F.max("time")).collect()
    assert sorted(tuple(row) for row in spans if row.part == "train") == [
        ("train", 0, 0, 265),
        ("train", 1, 266, 532),
        ("train", 2, 533, 799),
    ]
    assert parted.where("part = 'test'").agg(F.min("time"), F.count("*")).first() == (800, 200)
    with pytest.raises(ValueError, match="share"):
        chronological_split(df, 1.5)
    with pytest.raises(ValueError, match="too few"):
        chronological_split(df.limit(2), 0.8, folds=3)


def test_training_settings_from_a_file(tmp_path):
    path = tmp_path / "training.json"
    path.write_text('{"inputs": ["wind_actual"], "folds": 2, "grid": {"max_depth": [3]}}', encoding="utf-8")
    spec = command.read_training(str(path))
    assert (spec.inputs, spec.folds, spec.grid, spec.target) == (("wind_actual",), 2, {"max_depth": [3]}, "load_actual")
    with pytest.raises(ValueError, match="dropped"):
        TrainingSpec(inputs=("load_forecast",))


def test_training_finds_a_plain_relation(spark, tmp_path):
    start = dt.datetime(2020, 1, 1)
    rows = [(start + dt.timedelta(hours=h), 10.0 * (h % 24) + 5, float(h % 24), float(h % 7), 1.0) for h in range(400)]
    rows += [(start, None, 1.0, 1.0, 1.0)]
    inputs = "solar_actual double, wind_actual double, wind_offshore double"
    df = spark.createDataFrame(rows, f"time timestamp_ntz, load_actual double, {inputs}")
    grid = {"n_estimators": [2, 8], "max_depth": [4], "min_samples_split": [1], "learning_rate": [0.3]}
    spec = TrainingSpec(grid=grid)
    result = train(df, spec)
    assert result.best["n_estimators"] == 8 and set(result.best) == set(spec.grid)
    scores = result.scores.first()
    assert scores.scored_rows == 80 and scores.mae < 20
    assert save_predictions(result, str(tmp_path / "predictions")) == 80
