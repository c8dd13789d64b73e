"""Number expressions: display text and division by IEEE rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_number(value: Column) -> Column:
    """Shortest text of a double in plain notation, with at least one decimal: ``15000000.0``."""
    text = value.cast("string")
    plain = F.regexp_replace(text.cast("decimal(38,18)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return F.when(text.contains("E") & F.abs(value).between(1e-4, 1e16), plain).otherwise(text)


def with_unit(value: Column, unit: str) -> Column:
    return F.concat(plain_number(value), F.lit(f" {unit}"))


def ieee_divide(a: Column, b: Column) -> Column:
    """Double division that gives infinities and NaN for a zero divisor instead of an error."""
    at_zero = F.when((a == 0) | F.isnan(a), F.lit(float("nan"))).otherwise(F.signum(a) * F.lit(float("inf")))
    return F.when(b == 0, at_zero).otherwise(F.try_divide(a, b))
