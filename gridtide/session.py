"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

# Settings a cluster run and a local run both want.  Sizes (memory, cores,
# shuffle partitions) are left to the deployment.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "gridtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables a job writes and reads back.

    The cluster names it in ``spark.checkpoint.dir``.  A folder of our own is made
    only in local mode, where driver and executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach.")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="gridtide-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def share_code(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [part for part in environment.get("PYTHONPATH", "").split(os.pathsep) if part]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
