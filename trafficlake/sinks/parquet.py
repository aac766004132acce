"""Parquet tables partitioned by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.operators.columns import conform
from trafficlake.schemas import PARTITION_KEY, Table, table
from trafficlake.session import Metrics


def table_path(base: str, name: str) -> str:
    """Folder of a table; ``base`` is a local folder or any Hadoop URI."""
    return f"{base.rstrip('/')}/{name}"


def _resolve(to: str | Table) -> Table:
    return table(to) if isinstance(to, str) else to


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files in a folder; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return set()
    return {status.getPath().getName() for status in system.listStatus(path)}


def write_table(
    df: DataFrame, base: str, to: str | Table, days: Sequence[str] | None = None
) -> None:
    """Write a frame as its registered table.

    A partitioned table replaces the days the frame holds and leaves the others alone;
    an unpartitioned one is replaced as a whole. ``days`` lists the days this run stands
    for: those without rows become typed empty partitions. Rows are rebalanced by day:
    small days share a task, a heavy day is cut into several files.
    """
    target = _resolve(to)
    spark = df.sparkSession
    rows = conform(df, target)
    path = table_path(base, target.name)
    if not target.partitioned:
        rows.write.mode("overwrite").parquet(path)
        return
    found = Metrics(days=F.collect_set(PARTITION_KEY))
    if days:  # which of these days have rows is told by the job that writes them
        rows = found.watch(rows)
    (
        rows.hint("rebalance", PARTITION_KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_KEY)
        .parquet(path)
    )
    schema = T.StructType([f for f in target.schema.fields if f.name != PARTITION_KEY])
    for day in sorted(set(days) - set(found["days"] or ())) if days else ():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{PARTITION_KEY}={day}")


def read_table(
    spark: SparkSession, base: str, to: str | Table, first: str | None = None, last: str | None = None
) -> DataFrame:
    """A stored table with its registered schema, optionally from day ``first`` to ``last``.

    The day range is a filter on the directory column, so other days are not listed as
    input. Asking for days of an unpartitioned table is an error.
    """
    target = _resolve(to)
    if not target.partitioned and (first is not None or last is not None):
        raise ValueError(f"{target.name} is not partitioned")
    df = spark.read.schema(target.schema).parquet(table_path(base, target.name))
    if first is not None:
        df = df.where(df[PARTITION_KEY] >= first)
    if last is not None:
        df = df.where(df[PARTITION_KEY] <= last)
    return df
