"""Catalog tables, SQL text and bounded local frames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gridtide.sources.files import add_version, count_rows, remove_folder, remove_old_versions

_NOTE = "gridtide."


def checked_name(name: str) -> str:
    """A plain, optionally dotted, table name; anything that needs quoting is refused."""
    if not all(part.isascii() and part.isidentifier() for part in name.split(".")):
        raise ValueError(f"{name!r} is not a plain table name.")
    return name


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _made_here(spark: SparkSession, name: str) -> dict[str, str]:
    """What ``replace_table`` noted with the name; empty for names it did not make."""
    if not spark.catalog.tableExists(name):
        return {}
    noted = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {key.removeprefix(_NOTE): value for key, value in noted.items() if key.startswith(_NOTE)}


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a Parquet table from a query, below ``path`` if given, else in the warehouse.

    The rows go to a folder of their own; the name, a view of one folder, moves to it in one catalog
    statement after the write.  If the write fails, the old rows stay; readers that run keep their
    files.  ``df`` may read the table it replaces and may have other columns.  One writer at a time.
    """
    spark, plain = df.sparkSession, checked_name(name)
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{plain.replace('.', '/')}"
    version, _ = add_version(df, root)
    notes = {"version": version, "root": root, "owned": str(path is None).lower()}
    noted = ", ".join(f"{_quoted(_NOTE + key)} = {_quoted(value)}" for key, value in notes.items())
    folder = version.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {plain} TBLPROPERTIES ({noted}) AS SELECT * FROM parquet.`{folder}`")
    remove_old_versions(spark, root, version)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists; files below a path that the caller named stay."""
    notes = _made_here(spark, checked_name(name))
    spark.sql(f"DROP {'VIEW' if notes else 'TABLE'} IF EXISTS {name}")
    if notes.get("owned") == "true":
        remove_folder(spark, notes["root"])


def table_stats(spark: SparkSession, name: str) -> dict[str, int]:
    """Rows and columns; the rows of a table made by ``replace_table`` come from its file footers."""
    table = spark.table(checked_name(name))
    notes = _made_here(spark, name)
    rows = count_rows(spark, notes["version"]).first()["rows"] if notes else table.count()
    return {"rows": rows, "columns": len(table.columns)}


def run_sql(
    spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None, **args: Any
) -> DataFrame:
    """Spark SQL text; ``{name}`` refers to a frame in ``views`` and ``:name`` to an argument."""
    return spark.sql(text, args=args or None, **(views or {}))


def fetch_frame(df: DataFrame, max_rows: int):
    """A result as a pandas frame, refused when it has more than ``max_rows`` rows."""
    frame = df.limit(max_rows + 1).toPandas()
    if len(frame) > max_rows:
        raise ValueError(f"Result has more than {max_rows} rows; keep it distributed or write it.")
    return frame
