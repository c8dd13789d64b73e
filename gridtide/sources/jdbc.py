"""Read-only tables of external databases through JDBC.

The driver jar comes with the deployment (``spark.jars.packages``).  Filters and column choices
are pushed to the database by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    partitions: int,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column with bounds spreads the read over ``partitions`` tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if (partition_column is None) != (bounds is None) or (partitions > 1 and bounds is None):
        raise ValueError("A split read needs both a partition column and its bounds.")
    if partition_column is not None and bounds is not None:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, partitions: int, **how: object) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, partitions, **how)).load()
