"""The corpus pipeline: five stages, each on all rows that the stage before it kept.

Quality rules drop what they reject, exact and near copies keep one row of each group, personal data is
taken out of the texts, and the rest is packed into sequences.  Rows without an id are kept or dropped
like others, repeated rows are copies; empty texts go in the first stage; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import exact_dedup, packing, privacy, quality_rules, simhash
from gridtide.llm.common import one_row_of_each, read_table, without_rows
from gridtide.llm.queries import vocabulary
from gridtide.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the likelihood ratio against trusted documents."""
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return without_rows(docs, quality_rules.quality_rules(docs, trusted).where("NOT kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of equal texts, and only one where that id and text are repeated."""
    found = exact_dedup.exact_duplicates(docs)
    return one_row_of_each(docs, found.where("kept"), F.col("text_sha256"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of linked fingerprints; one of each fingerprint where none has an id."""
    found = simhash.near_duplicates(docs)
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("print "), F.col("fingerprint").cast("string")))
    return one_row_of_each(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), group)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data and revealing words taken out of the texts."""
    return privacy.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of at most 2048 tokens, with its place in a sequence."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

# Hashes, likelihood ratios and byte-pair encoding have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
