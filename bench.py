"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores.  Every query is run to the
end without keeping its rows: twice to warm up, then three times, of which the median counts.
``alternatives`` holds other plans for the same results, for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.operators import marts, wide
from gridtide.plans.catalog import QUERIES
from gridtide.plans.event_tables import staged_load
from gridtide.session import build_session

HEADLINE = (
    "staging_load",
    "features_lag",
    "features_lag_blocks",
    "daily_peak_struct",
    "daily_peak_rank",
    "latest_days",
    "load_melt",
    "series_targets",
    "series_features",
    "quality_summary",
    "forecast_metrics",
    "forecast_metrics_by_hour",
    "metric_avg_by_label",
    "metric_counter_rate",
    "metric_topk",
    "metric_ratio",
    "alert_sustained",
    "train_split",
    "stored_latest_days",
)


def lag_in_one_task(spark, sf_dir) -> DataFrame:
    window = Window.orderBy("time", "event_id")
    lags = {new: F.lag(col, n).over(window) for new, (col, n) in wide.LAGS.items()}
    return wide.with_calendar(wide.with_forecast_error(staged_load(spark, sf_dir).withColumns(lags)))


def melt_by_union(spark, sf_dir) -> DataFrame:
    df = wide.with_forecast_error(staged_load(spark, sf_dir))
    parts = [df.select("time", F.lit(name).alias("Type"), F.col(name).alias("Load (MW)")) for name in marts.SERIES]
    return reduce(DataFrame.unionByName, parts)


ALTERNATIVES = {"lag_in_one_task": lag_in_one_task, "melt_by_union": melt_by_union}


def seconds(spark, sf_dir, build, runs: int = 3) -> float:
    taken = []
    for _ in range(runs + 2):
        began = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - began)
    return round(statistics.median(taken[2:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("gridtide-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: seconds(spark, sf_dir, QUERIES[name]) for name in HEADLINE}
    others = {name: seconds(spark, sf_dir, build) for name, build in ALTERNATIVES.items()}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "alternatives": others,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
