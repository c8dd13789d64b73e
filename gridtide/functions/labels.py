"""Label matchers over a ``map<string,string>`` column; an absent label reads as empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(labels: Column, name: str) -> Column:
    return F.coalesce(labels[name], F.lit(""))


def label_is(labels: Column, name: str, value: str) -> Column:
    return label(labels, name) == F.lit(value)


def label_is_not(labels: Column, name: str, value: str) -> Column:
    return label(labels, name) != F.lit(value)


def label_matches(labels: Column, name: str, pattern: str) -> Column:
    """The pattern has to match the whole label value, line breaks included."""
    return label(labels, name).rlike(rf"\A(?s:{pattern})\z")


def label_matches_not(labels: Column, name: str, pattern: str) -> Column:
    return ~label_matches(labels, name, pattern)
