"""Calendar and duration expressions that read the same in every session zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def utc_wall_clock(col: Column, dtype: T.DataType) -> Column:
    """An instant as the zone-less UTC wall clock; zone-less input passes unchanged."""
    if isinstance(dtype, T.TimestampNTZType):
        return col
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(
        secs=(F.unix_micros(col) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    )


def utc_instant(col: Column, dtype: T.DataType) -> Column:
    """A zone-less UTC wall clock as the instant it names; an instant passes unchanged."""
    if not isinstance(dtype, T.TimestampNTZType):
        return col
    since = (col - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return F.timestamp_micros((since.cast("decimal(18,6)") * F.lit(1_000_000)).cast("long"))


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, to the microsecond."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def seconds_of(duration: str) -> int:
    """``"15 seconds"``, ``"2 minutes"``, ``"1 hour"`` as seconds."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match.group(2) not in _UNIT_SECONDS or int(match.group(1)) == 0:
        raise ValueError(f"Not a positive duration: {duration!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


def duration(text: str) -> Column:
    """Interval column of a duration text."""
    return F.make_dt_interval(secs=F.lit(seconds_of(text)))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Sunday is 0 and Saturday is 6."""
    return F.dayofweek(ts) - F.lit(1)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * F.lit(60) + F.minute(ts)


def clock_text(minute: Column) -> Column:
    """Minute of the day as ``HH:MM`` text."""
    hours = F.lpad(F.floor(minute / F.lit(60)).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), F.lpad((minute % F.lit(60)).cast("string"), 2, "0"))


def month_text(ts: Column) -> Column:
    """Month as ``YYYY-MM`` text."""
    return F.date_format(ts, "yyyy-MM")


def in_month(ts: Column, month: str, dtype: T.DataType, ahead: str | None = None) -> Column:
    """``month_text(ts) == month`` in UTC, written as a half-open range the file scan can use.

    With ``ahead``, a duration, the month is that of ``ts + ahead``: the bounds move instead of the column, so
    that the range on a computed time still meets the stored one.
    """
    match = re.fullmatch(r"(\d{4})-(0[1-9]|1[0-2])", month)
    if not match:
        raise ValueError(f"Not a YYYY-MM month: {month!r}")
    year, number = int(match.group(1)), int(match.group(2))
    following = f"{year + number // 12:04d}-{number % 12 + 1:02d}"
    # An instant is compared with the UTC month whatever the zone of the session.
    zone = "+00:00" if isinstance(dtype, T.TimestampType) else ""
    first, after = (F.lit(f"{name}-01 00:00:00{zone}").cast(dtype.simpleString()) for name in (month, following))
    if ahead is not None:
        first, after = first - duration(ahead), after - duration(ahead)
    return (ts >= first) & (ts < after)
