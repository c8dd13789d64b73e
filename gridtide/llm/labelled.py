"""Bounded training samples and broadcast models, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id's decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, most: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``text`` and ``label`` of at most ``most`` labelled rows for which ``learn_from`` (on ``doc_id``) holds.

    The sample is the labelled ids with the smallest hashes, so it is the same in every run; its bound
    is what makes the broadcast of ids and the fit on the driver safe.  Ids with both labels or a null one are left out.
    """
    agreed = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(learn_from & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select(F.col("doc_id").alias("_id"), "label")
    )
    chosen = F.broadcast(agreed.orderBy(F.xxhash64("_id"), "_id").limit(most))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return source.join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
