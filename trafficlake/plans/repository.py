"""Repository traffic: referrers, paths, clones, views, forks, stargazers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators import columns as C
from trafficlake.operators.dedup import keep_first
from trafficlake.operators.quality import unique_or_fail
from trafficlake.schemas import PARTITION_KEY, table

# New names of counts, and columns left out.
POPULAR_NAMES = {
    "core_github_popular_referrers": {"count": "total_referrals", "uniques": "unique_referrals"},
    "core_github_popular_paths": {"count": "total_views", "uniques": "unique_views"},
}
SERIES_NAMES = {
    "core_github_clones": {"count": "total_clones", "uniques": "unique_clones"},
    "core_github_views": {"count": "total_views", "uniques": "unique_views"},
}
NOT_IN_FORKS = ("fork", "open_issues_count", "pull_request_creation_policy")
NOT_IN_STARGAZERS = ("gravatar_id", "avatar_url", "user_view_type")


def _checked(df: DataFrame, name: str) -> DataFrame:
    """Keys are unique within a partition: a day may be part of several of them."""
    target = table(name)
    keys = [*target.key, PARTITION_KEY] if target.partitioned else list(target.key)
    return unique_or_fail(C.conform(df, target), keys, f"{name}: key repeats")


def _time(column: str) -> Column:
    return times.readable(F.col(column), times.iso_time(F.col(column)))


def _day(column: str) -> Column:
    return times.readable(F.col(column), times.iso_date(F.col(column)), "date")


def build_popular(raw: DataFrame, name: str) -> DataFrame:
    renamed = C.rename(raw, POPULAR_NAMES[name])
    day = _day("metrics_date")
    return _checked(renamed.withColumn("metrics_date", day), name)


def build_series(raw: DataFrame, name: str, window_days: int = 7) -> DataFrame:
    """Daily counts of a snapshot, kept for the days its partition stands for.

    Snapshots cover two weeks and overlap; a partition ``D`` keeps ``D`` to
    ``D + window_days - 1``. Entries of one time stamp are kept once.
    """
    renamed = C.rename(raw, SERIES_NAMES[name])
    counts = [F.col(c) for c in SERIES_NAMES[name].values()]
    once = keep_first(renamed, [PARTITION_KEY, "timestamp"], counts)
    dated = once.withColumn("metrics_date", _day("timestamp"))
    first = F.to_date(PARTITION_KEY)
    inside = F.col("metrics_date").between(first, F.date_add(first, window_days - 1))
    return _checked(dated.where(inside), name)


def build_forks(raw: DataFrame) -> DataFrame:
    kept = C.drop_where(
        C.rename(raw, {"size": "size_kb"}), lambda c: "_url" in c or c in NOT_IN_FORKS
    )
    dated = kept.withColumns(
        {c: _time(c) for c in ("created_at", "updated_at", "pushed_at")}
    )
    return _checked(dated, "core_github_forks")


def build_stargazers(raw: DataFrame) -> DataFrame:
    kept = C.drop(raw, NOT_IN_STARGAZERS)
    dated = kept.withColumn("starred_at", _time("starred_at"))
    return _checked(dated, "core_github_stargazers")
