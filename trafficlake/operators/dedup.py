"""De-duplication. All forms combine on the map side, so a key or a repeated row
that fills a third of the input is reduced before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.operators.quality import unique_by_counts

_RANK = "__rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows that are equal in every column are kept once (partial and final hash aggregate)."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a stated order.

    ``row_number() = 1`` is planned as a group limit that runs before the shuffle:
    every map task sends on at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated rows once, compared by value, with the key checked on the way.

    Repeats are combined before the one shuffle of rows. The job fails, and a write publishes
    nothing, when two different rows share a key: the check counts the keys of the shuffled
    rows, which both sides of the plan share.
    """
    return unique_by_counts(distinct_rows(df), keys, "different rows share a key")


def latest(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Newest row, overall or per key. ``order`` names the newest row first."""
    if keys:
        return keep_first(df, keys, order)
    return df.orderBy(*order).limit(1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()
