"""Exact duplicates: frequent digests are settled on the map side, the rest by one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import ROW_HASH, SPACE, row_hash, stored, whole_text


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def frequent_digests(rows: DataFrame, most: int, tracked: int) -> list[int]:
    """Hashes of the most frequent digests by a Misra-Gries sketch of ``tracked`` counters per task.

    Spark's ``approx_top_k`` keeps such counters: each task decrements all of them when they are
    full, sketches are merged by adding counters, and every digest with over 1/``tracked`` of the
    rows survives.  At most ``most`` hashes reach the driver.
    """
    sketch = rows.agg(F.expr(f"approx_top_k(_hash, {most}, {tracked})").alias("top"))
    return [item["item"] for item in sketch.first()["top"] or [] if item["item"] is not None]


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = 1000,
    tracked: int = 8192,
    min_copies: int = 50,
) -> DataFrame:
    """One row per document with the row that stays for it.

    Texts are equal when their normalised SHA-256 digests are.  The sketch proposes frequent
    digests; an exact count verifies them, and the at most ``most`` winners with ``min_copies`` rows
    or more are broadcast with their smallest id and count, so their rows never move.  All other
    digests meet in one shuffle of (digest, id), where a group is small because the frequent ones
    are gone.

    A null text is empty, and an empty table gives no rows.  A null id stays only where every id of its
    group is null.  Rows that repeat both id and text cannot be told apart: each counts in
    ``group_size`` and all get the same ``kept``.  Other columns are not read, whatever their names.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    hexed = F.sha2(normalised(whole_text()), 256)
    rows = stored(
        source.select("doc_id", F.unhex(hexed).alias("digest"), row_hash()).withColumn("_hash", F.xxhash64("digest")),
        "digests",
    )
    proposed = frequent_digests(rows, most, tracked)
    rows, proposals = rows.select("doc_id", ROW_HASH, "digest"), rows.where(F.col("_hash").isin(proposed))
    counted = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    # At most `most` rows of 48 bytes, whatever the table's size.
    winners = F.broadcast(proposals.groupBy("digest").agg(*counted).where(F.col("group_size") >= min_copies))
    settled = rows.join(winners, "digest")
    group = Window.partitionBy("digest")
    others = rows.join(winners, "digest", "left_anti").withColumns(
        {"keep_id": F.min("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)}
    )
    return settled.unionByName(others).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        ROW_HASH,
    )
