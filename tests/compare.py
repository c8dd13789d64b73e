"""Side-by-side comparison of a Spark result with SQL run by DuckDB on the same tables, and plans as text."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return (2, value.isoformat())
    return (3, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda position: names[position])
    return sorted(tuple(_cell(row[position]) for position in order) for row in rows)


def differences(result, sql: str, connection) -> list[str]:
    """Why the results differ; empty when names, types, row counts and all values agree."""
    cursor = connection.execute(sql)
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    kinds = {field.name: field.dataType.simpleString() for field in result.schema}
    actual_types = {name: KINDS.get(kind, kind) for name, kind in kinds.items()}
    if actual_types != expected_types:
        return [f"types {actual_types} instead of {expected_types}"]
    actual = [tuple(row) for row in result.collect()]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows instead of {len(expected)}"]
    left, right = _rows(result.columns, actual), _rows(list(expected_types), expected)
    return [f"{a} instead of {b}" for a, b in zip(left, right) if a != b][:3]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
