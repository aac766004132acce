"""Queries for reports: value counts, shares, calendars, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import numbers, times
from trafficlake.operators import reports
from trafficlake.queries.bindings import ACCESS_LOG_SQL, access_log, read

WORDS = ("pro", "err", "nightly", "stable")


def topk_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Top 10 keys, and all counts of the keys that hold one of some words."""
    log = access_log(spark, d)
    top = reports.value_counts(log, "key", 10).withColumn("report", F.lit("top"))
    chosen = reports.value_counts(reports.matching(log, "key", WORDS), "key")
    return top.unionByName(chosen.withColumn("report", F.lit("words")))


def topk_value_share(spark: SparkSession, d: str) -> DataFrame:
    """Top 3 event types with their share, and the share they cover together."""
    rows = reports.top_shares(read(spark, d, "events"), "event_type", 3, "(top 3)")
    return rows.withColumn("share", F.round("share", 9))


def _activity(spark: SparkSession, d: str) -> DataFrame:
    """Orders and events on one time line; the years between them have no rows."""
    orders = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("moment"), F.col("o_totalprice").alias("size")
    )
    events = read(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("moment"), F.col("value").alias("size")
    )
    return orders.unionByName(events)


def resample_weekly(spark: SparkSession, d: str) -> DataFrame:
    out = reports.resample_weekly(
        _activity(spark, d), "moment", F.sum("size").alias("total"), F.count("id").alias("n")
    )
    return out.withColumn("total", F.round(numbers.megabytes(F.col("total")), 6))


def resample_monthly(spark: SparkSession, d: str) -> DataFrame:
    out = reports.resample_monthly(_activity(spark, d), "moment", F.sum("size").alias("total"))
    return out.withColumn("total", F.round(numbers.gigabytes(F.col("total")), 9))


def calendar(spark: SparkSession, d: str) -> DataFrame:
    bounds = read(spark, d, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return times.calendar(bounds, "first", "last", "1 day")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "lang", "n_chars")
    joined = docs.join(read(spark, d, "labels"), "doc_id", "left")
    return joined.withColumn("nothing", F.lit(None).cast("string"))


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return reports.null_profile(_labelled(spark, d))


def null_split(spark: SparkSession, d: str) -> DataFrame:
    return reports.null_split(_labelled(spark, d), "quality")


def argmax_row(spark: SparkSession, d: str) -> DataFrame:
    ties = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    return reports.argmax_row(read(spark, d, "lineitem"), "l_extendedprice", *ties)


def describe_column(spark: SparkSession, d: str) -> DataFrame:
    out = reports.describe(read(spark, d, "events"), "value")
    return out.select("n", *[F.round(c, 6).alias(c) for c in out.columns if c != "n"])


QUERIES = {
    f.__name__: f
    for f in (
        topk_value_counts, topk_value_share, resample_weekly, resample_monthly, calendar,
        null_profile, null_split, argmax_row, describe_column,
    )
}

_PROFILE = [
    ("doc_id", "bigint"), ("lang", "string"), ("n_chars", "bigint"), ("quality", "int"),
    ("toxic", "int"), ("nothing", "string"),
]

_ACTIVITY = """activity as (select o_orderkey as id, o_orderdate as moment, o_totalprice as size from orders
  union all select event_id, ts, value from events)"""

ORACLE = {
    "topk_value_counts": f"""with {ACCESS_LOG_SQL}
(select key, count(*) as n, 'top' as report from access_log where key is not null
 group by key order by n desc, key limit 10)
union all (select key, count(*), 'words' from access_log
 where regexp_matches(key, 'pro|err|nightly|stable') group by key)""",
    "topk_value_share": """with c as (select event_type, count(*) as n from events where event_type is not null group by 1),
s as (select event_type, n, n / (select sum(n) from c) as share from c order by n desc, event_type limit 3)
select event_type, n, round(cast(share as double), 9) as share from s
union all select '(top 3)', null, round(cast(sum(share) as double), 9) from s""",
    "resample_weekly": f"""with {_ACTIVITY},
w as (select cast(date_trunc('week', moment) as date) + 6 as period,
    sum(size) as total, count(id) as n from activity group by 1),
days as (select cast(unnest(generate_series(min(period)::timestamp, max(period)::timestamp,
  interval 7 day)) as date) as period from w)
select days.period, round(coalesce(total, 0) / 1e6, 6) as total, coalesce(n, 0) as n
from days left join w on days.period = w.period""",
    "resample_monthly": f"""with {_ACTIVITY},
m as (select last_day(moment) as period, sum(size) as total from activity group by 1),
months as (select last_day(unnest(generate_series(date_trunc('month', min(period))::timestamp,
  max(period)::timestamp, interval 1 month))) as period from m)
select months.period, round(coalesce(total, 0) / 1e9, 9) as total
from months left join m on months.period = m.period""",
    "calendar": """select cast(unnest(generate_series(date_trunc('day', min(o_orderdate))::timestamp,
  max(o_orderdate), interval 1 day)) as date) as day from orders""",
    "null_profile": "with l as (select d.doc_id, lang, n_chars, quality, toxic, cast(null as varchar) as nothing\n"
    "  from documents d left join labels l on d.doc_id = l.doc_id)\n"
    + "\nunion all ".join(
        f"select '{c}' as \"column\", '{kind}' as type, count({c}) as n_values,"
        f" count(*) - count({c}) as n_nulls, count({c}) = 0 and count(*) > 0 as all_null from l"
        for c, kind in _PROFILE
    ),
    "null_split": """select quality is null as is_null, count(*) as n
from documents d left join labels l on d.doc_id = l.doc_id group by 1""",
    "argmax_row": """select * from lineitem where l_extendedprice is not null
order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity limit 1""",
    "describe_column": """select count(value) as n, round(avg(value), 6) as mean, min(value) as min,
  max(value) as max, round(quantile_cont(value, 0.25), 6) as q25,
  round(quantile_cont(value, 0.5), 6) as q50, round(quantile_cont(value, 0.75), 6) as q75 from events""",
}
