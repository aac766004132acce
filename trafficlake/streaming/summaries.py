"""Daily summaries that stay right however late, and in whatever batches, rows arrive.

Each batch adds the signed sums of its new rows, at the finest key of the three summaries, as a part of its own to the days it
touches; the summaries of those days are derived again from the parts, other days are neither read nor written. Parts are small
(sums, not rows) and additive, so their order does not matter.

A batch goes in three steps: its part, its rows, the summaries. What is new in it is settled against the stored rows by key. A
batch that failed is run again under its number: before its rows were stored the same part replaces itself, afterwards nothing
is new and the part stays. The numbers are those of one stream's checkpoint, which belongs to the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlake.operators import columns as C
from trafficlake.operators.dedup import distinct_by_key
from trafficlake.operators.summaries import FINEST, SUMS, summaries_at_once, usage_cube
from trafficlake.plans.objectlog import build_daily_summaries
from trafficlake.schemas import PARTITION_KEY, table
from trafficlake.session import Staging, tune
from trafficlake.sinks.append import append_staged, new_rows, stored_keys
from trafficlake.sinks.parquet import write_table
from trafficlake.streaming.incremental import load_available

USAGE = "out_s3_logs"


class SummaryStore:
    """The usage log and its three summaries below ``target``, with the parts they are made of."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = tune(spark), target.rstrip("/")
        self.path = f"{self.target}/out_s3_daily_summary_parts"

    def add(self, usage: DataFrame, batch: int) -> int:
        """Take in a batch of usage rows; returns how many were new."""
        return self._take(usage, batch, 1)

    def retract(self, usage: DataFrame, batch: int) -> None:
        """Take rows back out of the summaries. They stay in the usage log, which only grows."""
        self._take(usage, batch, -1)

    def _take(self, usage: DataFrame, batch: int, sign: int) -> int:
        added = 0
        with Staging(self.spark) as stage:
            rows = stage.keep(distinct_by_key(C.conform(usage, USAGE), stored_keys(table(USAGE))))
            days = sorted(r[0] for r in rows.select(PARTITION_KEY).distinct().collect())
            if not days:
                return 0
            new = stage.keep(new_rows(rows, self.target, USAGE)) if sign > 0 else rows
            part = usage_cube(new, PARTITION_KEY, sign).withColumn("batch", F.lit(int(batch)))
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                PARTITION_KEY, "batch"
            ).parquet(self.path)
            if sign > 0:
                added = append_staged(new, self.target, USAGE)
            made = stage.keep(summaries_at_once(self.sums(days), PARTITION_KEY), "summary")
            for name, frame in build_daily_summaries(made).items():
                # a day can only lose all its rows when rows are taken back
                write_table(frame, self.target, name, days if sign < 0 else None)
        return added

    def sums(self, days: list[str]) -> DataFrame:
        """The parts of these days, added up."""
        stored = self.spark.read.parquet(self.path).withColumn(PARTITION_KEY, F.col(PARTITION_KEY).cast("string"))
        stored = stored.where(F.col(PARTITION_KEY).isin(*days))
        keys = ["time", PARTITION_KEY, *FINEST]
        return stored.groupBy(*[C.q(k) for k in keys]).agg(*[F.sum(s).alias(s) for s in SUMS])

    def add_available(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take in everything that has arrived since the last run, then stop."""
        return load_available(stream, lambda batch, number: self.add(batch, number) and None, checkpoint)
