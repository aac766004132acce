"""Sessions of an event stream.

``closed_sessions`` is the low-latency form: stateful sessions in event time that come out once the watermark has passed them;
rows later than that are lost to it. ``SessionStore`` is the exact form: what decides sessions is kept per partition and user
in a stored table, each micro-batch is merged into the partitions it touches, and events take their session from there. In
whatever order and batches the rows arrive, it gives the ids of ``with_sessions`` over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlake.operators.columns import q
from trafficlake.operators.sessions import GAP_SECONDS, labelled, session_bins, session_numbers
from trafficlake.session import Staging, tune
from trafficlake.sinks.append import path_exists
from trafficlake.streaming.incremental import load_available

LATENESS = "2 days"


def closed_sessions(
    events: DataFrame, user: str = "user_id", ts: str = "timestamp", partition: str = "partition_key",
    gap_seconds: int = GAP_SECONDS, lateness: str = LATENESS,
) -> DataFrame:
    """(partition, user, first, last, n_events) of each session of known users, emitted when it can grow no more.

    Events exactly the gap apart share a session, as in the batch form.
    """
    known = events.where(q(user).isNotNull()).withWatermark(ts, lateness)
    window = F.session_window(F.col(ts), f"{gap_seconds} seconds")
    return (
        known.groupBy(window.alias("session"), q(partition), q(user))
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n_events"))
        .drop("session")
    )


class SessionStore:
    """First and last instant and session number of each (partition, user, time bin), in one folder a partition."""

    def __init__(
        self, spark: SparkSession, path: str, user: str = "user_id", ts: str = "timestamp",
        partition: str = "partition_key", gap_seconds: int = GAP_SECONDS,
    ):
        self.spark, self.path = tune(spark), path.rstrip("/")
        self.user, self.ts, self.partition, self.gap = user, ts, partition, gap_seconds
        self.group = [partition, user]

    def stored(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if path_exists(self.spark, self.path) else None

    def merge(self, events: DataFrame) -> list[str]:
        """Take in events; returns the partitions whose numbers may have changed.

        Merging is by minimum and maximum, so events that come again change nothing, and a partition is replaced as a
        whole when the job has succeeded: a merge that failed is simply repeated.
        """
        known = events.where(q(self.user).isNotNull())
        with Staging(self.spark) as stage:
            bins = stage.keep(session_bins(known, self.group, self.ts, self.gap))
            touched = sorted(r[0] for r in bins.select(q(self.partition)).distinct().collect())
            if not touched:
                return []
            stored = self.stored()
            if stored is not None:
                old = stored.where(q(self.partition).cast("string").isin(*map(str, touched)))
                bins = bins.unionByName(old.select(*[old[c].cast(bins.schema[c].dataType).alias(c) for c in bins.columns]))
            keys = [*self.group, "__bin"]
            merged = bins.groupBy(*[q(k) for k in keys]).agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"))
            merged = stage.keep(merged)
            numbers = session_numbers(merged, self.group, self.gap)
            rows = stage.keep(merged.join(numbers, keys))
            rows.hint("rebalance", self.partition).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(self.partition).parquet(self.path)
        return touched

    def numbers(self, events: DataFrame) -> DataFrame:
        keys = [*self.group, "__bin", "session_number"]
        stored = self.stored()
        if stored is None:
            empty = session_bins(events.limit(0), self.group, self.ts, self.gap)
            return session_numbers(empty, self.group, self.gap)
        return stored.select(*[stored[k].cast(events.schema[k].dataType).alias(k) if k in self.group else stored[k] for k in keys])

    def with_sessions(self, events: DataFrame) -> DataFrame:
        """``events`` (any that were merged) with their ``session_id``; NULL where the user is unknown."""
        return labelled(events, self.numbers(events), self.user, self.ts, self.partition, self.gap)

    def merge_available(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merge everything that has arrived since the last run, then stop."""
        return load_available(stream, lambda batch, _: self.merge(batch) and None, checkpoint)
