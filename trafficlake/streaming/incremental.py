"""The daily object-log load as an incremental job.

The batch load reads the files of a day again; this one reads each new file once. Repeated
rows are settled within each micro-batch and against the stored partitions it touches, so
both give the same tables however late a row arrives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlake.operators import columns as C
from trafficlake.operators.dedup import distinct_by_key
from trafficlake.operators.enrich import ip_dimension
from trafficlake.operators.joins import lookup
from trafficlake.operators.summaries import parquet_only, usage_measures
from trafficlake.plans import objectlog
from trafficlake.schemas import table
from trafficlake.sinks.append import append_new, stored_keys
from trafficlake.site import Site
from trafficlake.sources.files import object_log_stream

LATENESS = "2 days"


def core_stream(spark: SparkSession, root: str, ip_records: DataFrame) -> DataFrame:
    """Typed access log of new files. Repeats are left to ``append_available``: no state is kept."""
    rows = objectlog.measured(objectlog.typed_rows(object_log_stream(spark, root)))
    return C.conform(lookup(rows, ip_dimension(ip_records), ["remote_ip"]), "core_s3_logs")


def usage_stream(core: DataFrame, site: Site) -> DataFrame:
    return C.conform(objectlog.usage_rows(core, site), "out_s3_logs")


def summary_stream(usage: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Daily summary by table of a usage stream; a day is emitted once it is closed.

    Rows that come ``lateness`` after the newest are too late for an emitted day, and an id
    repeated within it counts once; the stored tables keep all rows.
    """
    day = F.window("time", "1 day")
    once = usage.withWatermark("time", lateness).dropDuplicatesWithinWatermark(["id", "partition_key"])
    return (
        parquet_only(once)
        .groupBy(day.alias("day"), "partition_key", "usage_type", "table", "version")
        .agg(*usage_measures())
        .withColumn("time", F.col("day.start"))
        .drop("day")
    )


def load_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_available(stream: DataFrame, target: str, name: str, checkpoint: str) -> StreamingQuery:
    """As ``load_available``, into a stored table. A batch that is run again after a
    failure adds nothing twice: rows whose key is stored are skipped. Different rows of one
    key within a batch fail it, as they fail the batch load."""

    def write(batch: DataFrame, _: int) -> None:
        append_new(distinct_by_key(batch, stored_keys(table(name))), target, name)

    return load_available(stream, write, checkpoint)
