"""Daily summaries. Every aggregate here combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import text
from trafficlake.operators.columns import q


def by_day(
    logs: DataFrame, keys: Sequence[str], measures: Sequence[Column], time: str = "time"
) -> DataFrame:
    """Tumbling daily groups with further keys. NULL keys form groups of their own."""
    day = F.date_trunc("day", F.col(time)).alias(time)
    return logs.groupBy(day, *[q(k) for k in keys]).agg(*measures)


def usage_measures() -> list[Column]:
    return [
        F.sum("normalized_file_downloads").alias("normalized_file_downloads"),
        F.count("request_uri").alias("request_count"),
        F.round(F.sum("megabytes_sent"), 3).alias("megabytes_sent"),
    ]


def _extra(partition: str | None) -> list[str]:
    return [partition] if partition else []


def parquet_only(logs: DataFrame) -> DataFrame:
    return logs.where(F.endswith(F.col("table"), F.lit(".parquet")))


def summary_by_table(logs: DataFrame, partition: str | None = None) -> DataFrame:
    """Per day, usage type, table and version; Parquet tables only."""
    return by_day(
        parquet_only(logs),
        [*_extra(partition), "usage_type", "table", "version"],
        usage_measures(),
    )


def summary_by_user(logs: DataFrame, partition: str | None = None) -> DataFrame:
    """Per day, address, table, organisation and country, with the usual usage type.

    Rows are summed per usage type first, by hash and on the map side, and the usual type
    is found among those few sums; a mode over the rows would sort all of them.
    """
    keys = [*_extra(partition), "remote_ip", "table", "remote_ip_org", "remote_ip_country_name"]
    per_type = by_day(
        parquet_only(logs),
        [*keys, "usage_type"],
        [
            F.sum("normalized_file_downloads").alias("downloads"),
            F.count("request_uri").alias("requests"),
            F.sum("megabytes_sent").alias("megabytes"),
            F.count("usage_type").alias("__n"),
        ],
    )
    return per_type.groupBy("time", *[q(k) for k in keys]).agg(
        F.sum("downloads").alias("normalized_file_downloads"),
        F.sum("requests").alias("request_count"),
        F.round(F.sum("megabytes"), 3).alias("megabytes_sent"),
        _most_frequent("usage_type").alias("usage_type"),
    )


def _most_frequent(column: str) -> Column:
    """Of values counted in ``__n``: the most frequent, the smallest on ties."""
    return F.min(F.struct(-F.col("__n"), q(column)))[column]


def summary_by_db(logs: DataFrame, partition: str | None = None) -> DataFrame:
    """Per day, usage type, database and version; folders are left out."""
    files = logs.where(~F.endswith(F.col("table"), F.lit("/")))
    return by_day(
        files.withColumn("database", text.database_of(F.col("table"))),
        [*_extra(partition), "usage_type", "database", "version"],
        usage_measures(),
    )


FINEST = ("usage_type", "table", "version", "remote_ip", "remote_ip_org", "remote_ip_country_name")
SUMS = ("downloads", "requests", "megabytes", "typed", "rows")


def usage_cube(logs: DataFrame, partition: str | None = None, sign: int = 1) -> DataFrame:
    """Additive sums at the finest key that the three summaries share.

    Cubes of different rows add up, in any order; with ``sign`` -1 rows are taken back.
    """
    amounts = {
        "downloads": F.sum("normalized_file_downloads"),
        "requests": F.count("request_uri"),
        "megabytes": F.sum("megabytes_sent"),
        "typed": F.count("usage_type"),
        "rows": F.count(F.lit(1)),
    }
    return by_day(logs, [*_extra(partition), *FINEST], [(v * sign).alias(name) for name, v in amounts.items()])


def summaries_at_once(cube: DataFrame, partition: str | None = None) -> DataFrame:
    """All three summaries of a ``usage_cube``, told apart by ``summary``: by_table, by_user, by_db.

    Grouping sets over the cube's few rows, so the log itself is read and shuffled once. A key that a summary lacks is
    NULL in it. What is summed per usage type and user gives the user's sums and usual type.
    """
    table = F.col("table")
    cube = cube.withColumns(
        {
            "database": text.database_of(table),
            "__parquet": F.coalesce(F.endswith(table, F.lit(".parquet")), F.lit(False)),
            "__file": F.coalesce(~F.endswith(table, F.lit("/")), F.lit(False)),
        }
    )
    common = ["time", *_extra(partition), "usage_type"]
    sets = [
        [*common, "table", "version", "__parquet"],
        [*common, "table", "remote_ip", "remote_ip_org", "remote_ip_country_name", "__parquet"],
        [*common, "database", "version", "__file"],
    ]
    keys = [*dict.fromkeys(k for keys in sets for k in keys)]
    grouped = cube.groupingSets([[q(k) for k in keys] for keys in sets], *[q(k) for k in keys]).agg(
        *[F.sum(name).alias(name) for name in SUMS],
        F.grouping("database").alias("no_db"),
        F.grouping("remote_ip").alias("no_user"),
    )
    kind = F.when(F.col("no_db") == 0, "by_db").when(F.col("no_user") == 0, "by_user").otherwise("by_table")
    kept = grouped.withColumn("summary", kind).where(
        F.coalesce(F.col("__parquet"), F.col("__file")) & (F.col("rows") != 0)
    )
    of_user = F.col("summary") == "by_user"
    rest = [k for k in keys if not k.startswith("__") and k != "usage_type"]
    usual = F.min(F.struct((-F.col("typed")).alias("n"), q("usage_type")))["usage_type"]
    return (
        kept.groupBy("summary", *[q(k) for k in rest], F.when(~of_user, F.col("usage_type")).alias("__type"))
        .agg(
            F.sum("downloads").alias("normalized_file_downloads"),
            F.sum("requests").alias("request_count"),
            F.round(F.sum("megabytes"), 3).alias("megabytes_sent"),
            usual.alias("usage_type"),
        )
        .drop("__type")
    )


def mode_per_group(df: DataFrame, keys: Sequence[str], column: str, name: str | None = None) -> DataFrame:
    """Most frequent value per group, the smallest on ties, NULL where there is none.

    Values are counted per (group, value) first, so the state per group is one row no
    matter how many distinct values a group has.
    """
    counts = df.groupBy(*[q(k) for k in keys], q(column)).agg(F.count(column).alias("__n"))
    return counts.groupBy(*[q(k) for k in keys]).agg(_most_frequent(column).alias(name or column))
