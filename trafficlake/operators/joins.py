"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.operators.columns import q
from trafficlake.operators.quality import unique_by_counts

_SPREAD = 8_192


def most_frequent(counts: DataFrame, keys: Sequence[str], count: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-NULL keys of a table of key counts.

    Any other key holds at most 1/(n+1) of the counted rows.
    """
    given = counts
    for k in keys:
        given = given.where(q(k).isNotNull())
    return given.orderBy(F.col(count).desc(), *keys).limit(n).select(*keys)


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``rows`` to a dimension that is unique on ``keys``, by a shuffle.

    Rows with a NULL key match nothing; they are spread over all tasks instead of sharing
    one. A key with very many rows makes one large shuffle partition, which adaptive
    execution cuts into pieces (``spark.sql.adaptive.skewJoin``). Where that is not
    available, ``hot`` lists the most frequent keys (see ``most_frequent``): their
    dimension rows, at most as many as ``hot`` has, are broadcast and the rows they match
    are spread like those without a key. Every row of ``rows`` comes out exactly once.
    """
    keys = list(keys)
    values = [c for c in dimension.columns if c not in keys]
    settled = F.lit(False)
    for k in keys:
        settled = settled | q(k).isNull()
    left = rows
    if hot is not None:
        hot_part = dimension.join(F.broadcast(hot), keys, "left_semi").select(
            *[q(k) for k in keys], F.struct(*[q(v) for v in values]).alias("__hot")
        )
        left = rows.join(F.broadcast(hot_part), keys, "left")
        settled = settled | F.col("__hot").isNotNull()
    salt = F.pmod(F.xxhash64(*[q(c) for c in rows.columns]), F.lit(_SPREAD)) + 1
    left = left.withColumn("__spread", F.when(settled, salt).otherwise(F.lit(0).cast("bigint")))
    # 0 for every row, yet not a constant the optimizer could take out of the join key
    right = dimension.withColumn(
        "__spread", F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(1))
    )
    if hot is None:
        return left.join(right, [*keys, "__spread"], "left").select(
            *[q(c) for c in rows.columns], *[q(v) for v in values]
        )
    right = right.select(
        *[q(k) for k in keys], "__spread", F.struct(*[q(v) for v in values]).alias("__rest")
    )
    return left.join(right, [*keys, "__spread"], "left").select(
        *[q(c) for c in rows.columns],
        *[F.coalesce(F.col("__hot")[v], F.col("__rest")[v]).alias(v) for v in values],
    )


def many_to_one(
    rows: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    validate: bool = True,
    hot_keys: int = 0,
) -> DataFrame:
    """Left join, dimension keys checked to be unique by the job itself.

    No side is forced: adaptive execution sends a dimension to all tasks when its measured
    bytes allow it and shuffles otherwise. ``hot_keys`` > 0 counts the keys of ``rows`` first
    and treats that many of the most frequent ones apart; it reads ``rows`` twice, so it is
    meant for stored rows where adaptive execution is not available.
    """
    if validate:
        dimension = unique_by_counts(dimension, keys, "dimension key repeats")
    hot = None
    if hot_keys:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        hot = most_frequent(counts, keys, "__n", hot_keys)
    return lookup(rows, dimension, keys, hot)


def new_by_key(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet. Only the key columns of ``stored`` are read."""
    return rows.join(stored.select(*[q(k) for k in keys]), list(keys), "left_anti")


def map_values(column: Column, mapping: dict[str, str]) -> Column:
    """Lookup in a small literal mapping; unknown values give NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), column)
