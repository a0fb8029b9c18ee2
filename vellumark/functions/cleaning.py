"""Tolerant parsers for raw text columns: a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def primary_value(column: Column) -> Column:
    """First item of a comma list, trimmed; null stays null, blank stays blank."""
    return F.trim(F.get(F.split(column, ","), F.lit(0)))


def tolerant_int(column: Column) -> Column:
    return column.try_cast("int")


def long_date(column: Column) -> Column:
    """Dates such as ``September 1, 2020``."""
    return F.try_to_date(F.trim(column), "MMMM d, yyyy")


def first_integer(column: Column) -> Column:
    return F.regexp_extract(column, r"(\d+)", 1).try_cast("int")
