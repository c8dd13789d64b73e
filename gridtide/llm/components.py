"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a")
    own = least.select("a", F.col("least").alias("b"))
    return moved.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges (``a``, ``b``: long); the root is the smallest node.

    Each round is a grouped minimum and a join, never a collected neighbourhood, and is written to
    the shared folder.  Rounds grow with the logarithm of the longest path.  It ends when a round
    changes nothing: then every edge points from a node to its root.
    """
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))]
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    seen = tuple(current.agg(*mark).first())
    while True:
        after = stored(_small_star(_large_star(current)), "edges")
        found = tuple(after.agg(*mark).first())
        discard(current)
        current = after
        if found == seen:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = found
