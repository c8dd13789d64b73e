"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.session import scratch_path

# Fixed value: white space of the word definition, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
ROW_HASH = "_row_hash"


def share_code(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [part for part in environment.get("PYTHONPATH", "").split(os.pathsep) if part]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage.

    The planner then knows its size, so a join with it is broadcast only below Spark's own threshold.
    """
    share_code(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    jvm, jsc = table.sparkSession._jvm, table.sparkSession._jsc
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose frames are gone.

    It does so when the driver collects its garbage, which a long chain of stored steps with a quiet
    driver may not reach before the disks of the executors fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole_text(name: str = "text") -> Column:
    """The text of a row; a null text is empty."""
    return F.coalesce(F.col(name), F.lit(""))


def row_hash(text: str = "text") -> Column:
    """With the id it tells rows apart that repeat an id with other texts."""
    return F.xxhash64(whole_text(text)).alias(ROW_HASH)


def without_rows(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less the rows named by ``dropped`` (its id column and ``ROW_HASH``).

    The plan is the same at every size: both sides meet by id and hash, and the narrow one is hashed in
    each task, so the texts move once and are not sorted.
    """
    own_id, own_hash = f"_id_{uuid.uuid4().hex}", f"_hash_{uuid.uuid4().hex}"
    gone = stored(dropped.select(F.col(doc_id).alias(own_id), F.col(ROW_HASH).alias(own_hash)), "dropped")
    return docs.join(gone.hint("shuffle_hash"), _is_row(doc_id, text, own_id, own_hash), "left_anti")


def _is_row(doc_id: str, text: str, own_id: str, own_hash: str) -> Column:
    return F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(whole_text(text)) == F.col(own_hash))


def one_row_of_each(docs: DataFrame, staying: DataFrame, group: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each ``group`` of ``staying`` (id column and ``ROW_HASH``, rows that may stay for their group).

    The row with the smallest id, then hash, stays; of rows equal in both any one, the others are alike.  Only rows that are
    there several times are compared as a whole.
    """
    own_id, own_hash = f"_id_{uuid.uuid4().hex}", f"_hash_{uuid.uuid4().hex}"
    row = F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), F.col(ROW_HASH).alias("hash"))
    rows = staying.groupBy(group.alias("_group"), row.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("_group").agg(F.min(F.struct("row", "n")).alias("first"))
    chosen = first.select(F.col("first.row.id").alias(own_id), F.col("first.row.hash").alias(own_hash), "first.n").distinct()
    chosen = stored(chosen, "staying")
    same = _is_row(doc_id, text, own_id, own_hash)
    once = docs.join(chosen.where("n = 1").hint("shuffle_hash"), same, "left_semi")
    several = docs.join(chosen.where("n > 1").hint("shuffle_hash"), same, "left_semi")
    numbered = several.withColumn(own_hash, F.xxhash64(whole_text(text)))
    return once.unionByName(numbered.dropDuplicates([doc_id, own_hash]).drop(own_hash))
