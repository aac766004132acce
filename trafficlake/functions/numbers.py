"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_null(c: Column, as_type: str = "double") -> Column:
    """Text as a number; text that is none becomes NULL.

    The log's NULL mark ``-`` is taken out first: a failing cast is costly and ``-`` is the
    one bad value that is common.
    """
    return F.when(c != "-", F.trim(c)).try_cast(as_type)


def dash_to_zero(c: Column) -> Column:
    return F.when(c == "-", F.lit("0")).otherwise(c)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL where the whole is zero, so sums stay finite."""
    return F.try_divide(part, whole)


def megabytes(c: Column) -> Column:
    return c / F.lit(1e6)


def gigabytes(c: Column) -> Column:
    return c / F.lit(1e9)
