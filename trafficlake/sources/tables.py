"""Tables kept in a database."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.operators.columns import conform
from trafficlake.schemas import PARTITION_KEY, table

log = logging.getLogger(__name__)


def read_jdbc_table(
    spark: SparkSession, name: str, options: dict[str, str], partition: str | None = None
) -> DataFrame:
    """A registered table, or one partition of it, with registered types.

    The partition predicate is pushed to the database. A partition of an unpartitioned
    table is an error, found before anything is read; an empty result is only logged.
    Parallel reads take Spark's ``partitionColumn`` options.
    """
    target = table(name)
    if partition is not None and not target.partitioned:
        raise ValueError(f"{name} is not partitioned")
    df = spark.read.format("jdbc").options(**options).option("dbtable", name).load()
    if partition is not None:
        df = df.where(F.col(PARTITION_KEY) == partition)
        if df.isEmpty():
            log.warning("%s: no data for partition %s", name, partition)
    return conform(df, target)


def time_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` (included) to ``end`` (excluded), both ``YYYY-MM-DD``.

    Literals take the type of the column, so the comparison reaches the scan.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    return df.where((c >= F.lit(start).cast(kind)) & (c < F.lit(end).cast(kind)))


def day_range(df: DataFrame, column: str, first: str, days: int = 1) -> DataFrame:
    """Rows of ``days`` whole days from ``first`` on."""
    kind = df.schema[column].dataType
    end = F.date_add(F.lit(first).cast("date"), days)
    c = F.col(column)
    return df.where((c >= F.lit(first).cast(kind)) & (c < end.cast(kind)))
