"""Sessions: runs of a user's events without a long pause."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.operators.columns import q
from trafficlake.operators.joins import lookup

GAP_SECONDS = 30 * 60
_NO_TIME = -(2**62)


def time_bin(ts: Column, seconds: int) -> Column:
    """Number of the half-open bin of ``seconds`` length an instant falls into."""
    micros = F.unix_micros(ts.cast("timestamp"))
    width = seconds * 1_000_000
    return F.coalesce(F.floor((micros - F.pmod(micros, F.lit(width))) / width), F.lit(_NO_TIME))


def session_bins(
    events: DataFrame, group: Sequence[str], ts: str, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """First and last instant, in microseconds, of each (group, time bin).

    Two events of one bin of gap length are always closer than the gap, so a bin lies in one
    session and only these two matter. A combining aggregate, which further events can join.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    return events.groupBy(
        *[q(g) for g in group], time_bin(F.col(ts), gap_seconds).alias("__bin")
    ).agg(F.min(at).alias("__first"), F.max(at).alias("__last"))


def session_numbers(
    bins: DataFrame, group: Sequence[str], gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Session number of each (group, time bin) of ``session_bins``.

    A new session starts where the pause is strictly longer than the gap. The window sees
    one row per bin, however many events a user has.
    """
    w = Window.partitionBy(*[q(g) for g in group]).orderBy("__bin")
    pause = F.col("__first") - F.lag("__last").over(w)
    starts = F.coalesce((pause > gap_seconds * 1_000_000).cast("bigint"), F.lit(0))
    return bins.withColumn("__starts", starts).select(
        *[q(g) for g in group],
        "__bin",
        (
            F.sum("__starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1
        ).alias("session_number"),
    )


def with_sessions(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "timestamp",
    partition: str = "partition_key",
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """Add ``session_id`` = ``<partition>-s<number>``; NULL where the user is unknown.

    Numbers start at 1 for each user and partition. The numbers go back to the events by
    a join on (partition, user, bin), so no task ever holds all events of a user, and
    adaptive execution can cut up a bin with very many events.
    """
    group = [partition, user]
    known = events.where(q(user).isNotNull())
    numbers = session_numbers(session_bins(known, group, ts, gap_seconds), group, gap_seconds)
    return labelled(events, numbers, user, ts, partition, gap_seconds)


def labelled(
    events: DataFrame, numbers: DataFrame, user: str, ts: str, partition: str, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """``events`` with the ``session_id`` that their bin has in ``numbers``."""
    binned = events.withColumn("__bin", time_bin(F.col(ts), gap_seconds))
    joined = lookup(binned, numbers, [partition, user, "__bin"])
    label = F.concat(q(partition), F.lit("-s"), F.col("session_number").cast("string"))
    return joined.withColumn("session_id", label).drop("__bin", "session_number")
