"""CSV and Parquet files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.sources.spec import SourceSpec

_VERSION = "version-"


def read_csv(spark: SparkSession, spec: SourceSpec, infer: bool = False) -> DataFrame:
    """Raw table of a source.

    Types come from the spec: the header line gives the column order, unmapped columns stay text
    and are never parsed when unused.  ``infer=True`` lets Spark guess all types instead, at the
    price of one more pass over the files.  A malformed value stops the job rather than turn null.
    """
    reader = spark.read.option("header", True).option("timeZone", "UTC")
    header = reader.csv(spec.raw_file).columns
    spec.require(header)
    if infer:
        found = reader.option("inferSchema", True).csv(spec.raw_file)
        # A guess from whole numbers, no values or one odd value must not change the declared type.
        return found.withColumns(
            {name: F.col(name).cast(spec.raw_type(name)) for name in spec.raw_columns if name != spec.timestamp}
        )
    schema = T.StructType([T.StructField(name, spec.raw_type(name)) for name in header])
    return reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(schema).csv(spec.raw_file)


def read_parquet(spark: SparkSession, path: str, made_by: str | None = None) -> DataFrame:
    """Parquet table, the newest whole version of a replaced one; a missing one names the stage that makes it."""
    try:
        return spark.read.parquet(newest_version(spark, path) or path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        hint = f" It comes from {made_by}, which has not run here." if made_by else ""
        raise FileNotFoundError(f"Parquet table not found: {path}.{hint}") from err


def write_parquet(df: DataFrame, path: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> int:
    """Replace the zstd Parquet table at ``path``; the row count comes from the write itself.

    ``sort_by`` writes range-ordered files, so that min/max statistics prune later reads;
    ``partition_by`` a folder per value, so that a filter on it leaves out whole folders.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return int(seen.get["rows"])


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _versions(spark: SparkSession, path: str, mark: str = "") -> list[str]:
    """Version folders below ``path`` that hold ``mark``, oldest first."""
    files, pattern = _file_system(spark, f"{path.rstrip('/')}/{_VERSION}*{mark}")
    found = [status.getPath().toString() for status in files.globStatus(pattern) or ()]
    return sorted(name.removesuffix(mark) for name in found)


def _number(version: str) -> int:
    return int(version.rpartition(_VERSION)[2].partition("-")[0])


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The newest version below ``path`` whose write came to its end; none for a plain table."""
    return max(_versions(spark, path, "/_SUCCESS"), default=None)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def add_version(df: DataFrame, path: str, **layout: Sequence[str]) -> tuple[str, int]:
    """Write ``df`` as a version of its own below ``path``; its folder and row count.

    Readers take it from the moment its success mark is there.  A write that fails removes its files and
    changes nothing for readers; those of a driver that is lost are removed by ``remove_old_versions``.
    """
    spark = df.sparkSession
    number = max(map(_number, _versions(spark, path)), default=0) + 1
    version = f"{path.rstrip('/')}/{_VERSION}{number:09d}-{uuid.uuid4().hex[:8]}"
    try:
        return version, write_parquet(df, version, **layout)
    except Exception:
        remove_folder(spark, version)
        raise


def remove_old_versions(spark: SparkSession, path: str, current: str) -> None:
    """Remove versions before the last but one, which jobs that started earlier may still read."""
    for version in _versions(spark, path):
        if _number(version) < _number(current) - 1:
            remove_folder(spark, version)


def replace_parquet(df: DataFrame, path: str, **layout: Sequence[str]) -> int:
    """``write_parquet`` as a replacement that is whole or does not happen; for ``read_parquet``, one writer at a time.

    ``df`` may read the table it replaces.
    """
    version, rows = add_version(df, path, **layout)
    remove_old_versions(df.sparkSession, path, version)
    return rows


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """``rows`` of a Parquet table from the footers of its files; no row is read.

    Spark pushes the count only into its newer reader, which a session does not use by default: the frame is
    planned here under that reader, and the settings of the session are put back.
    """
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        counted = spark.read.parquet(newest_version(spark, path) or path).agg(F.count(F.lit(1)).alias("rows"))
        counted._jdf.queryExecution().executedPlan()  # plans it now
        return counted
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
