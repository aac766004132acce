"""Queries over the access log: filters, scalars, usage log, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import numbers, text
from trafficlake.operators import summaries
from trafficlake.plans import objectlog
from trafficlake.queries.bindings import (
    ACCESS_LOG_SQL,
    LOG_WITH,
    SITE,
    TYPED_LOG_SQL,
    access_log,
    read,
    typed_log,
)
from trafficlake.queries.scans import Scratch
from trafficlake.sinks.parquet import read_table
from trafficlake.streaming.summaries import SummaryStore


def _usage(spark: SparkSession, d: str) -> DataFrame:
    return objectlog.usage_rows(typed_log(access_log(spark, d)), SITE)


def daily_summary_by_table(spark: SparkSession, d: str) -> DataFrame:
    out = summaries.summary_by_table(_usage(spark, d))
    return _rounded(out)


def _rounded(out: DataFrame) -> DataFrame:
    return out.withColumns(
        {
            "time": F.to_date("time"),
            "normalized_file_downloads": F.round("normalized_file_downloads", 6),
        }
    )


def daily_summary_by_user(spark: SparkSession, d: str) -> DataFrame:
    nation = read(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("k"),
        F.col("n_name").alias("remote_ip_org"),
        F.concat(F.lit("country_"), F.col("n_regionkey").cast("string")).alias(
            "remote_ip_country_name"
        ),
    )
    usage = _usage(spark, d).withColumn(
        "k", F.substring_index("remote_ip", ".", -1).cast("bigint") % 25
    )
    return _rounded(summaries.summary_by_user(usage.join(nation, "k", "left")))


def daily_summary_by_db(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(summaries.summary_by_db(_usage(spark, d)))


def _apart(usage: DataFrame) -> DataFrame:
    """Sizes whose sums lie on no rounding edge, so that the order of adding does not show."""
    return usage.withColumn("megabytes_sent", F.col("megabytes_sent") + 1e-7)


def daily_summaries_at_once(spark: SparkSession, d: str) -> DataFrame:
    """All three summaries from one scan and one shuffle of the log."""
    nation = read(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("remote_ip_org"), F.lit(None).cast("string").alias("remote_ip_country_name")
    )
    usage = _apart(_usage(spark, d)).withColumn("k", F.substring_index("remote_ip", ".", -1).cast("bigint") % 25)
    cube = summaries.usage_cube(usage.join(nation, "k", "left"))
    return _rounded(summaries.summaries_at_once(cube)).drop("remote_ip_country_name")


def summary_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """The stored summary by table after the log came in two batches, each with half of every day, and one came again."""
    scratch = Scratch(spark)
    store = SummaryStore(spark, scratch.path)
    usage = _apart(_usage(spark, d)).withColumn("id", F.col("id").cast("string"))
    batch = F.pmod(F.xxhash64("id"), F.lit(2))
    for number, part in enumerate((1, 0, 1)):
        store.add(usage.where(batch == part), number)
    made = read_table(spark, scratch.path, "out_s3_daily_summary_by_table")
    return scratch.finish(_rounded(made.select(
        "time", "usage_type", "table", "version", "normalized_file_downloads",
        F.col("request_count").cast("bigint").alias("request_count"), "megabytes_sent",
    )))


def usage_log_build(spark: SparkSession, d: str) -> DataFrame:
    out = _usage(spark, d)
    return out.select(
        "id", "time", "version", "table", "usage_type", "remote_ip", "key", "request_uri",
        "referer", "partition_key", F.round("megabytes_sent", 6).alias("megabytes_sent"),
        F.round("normalized_file_downloads", 6).alias("normalized_file_downloads"),
    )


def filter_predicates(spark: SparkSession, d: str) -> DataFrame:
    log = typed_log(access_log(spark, d))
    keep = (
        F.col("operation").isin(*objectlog.GET_OPERATIONS)
        | ~F.col("operation").eqNullSafe(objectlog.LIFECYCLE_OPERATION)
    ) & (F.col("megabytes_sent") > 0)
    return log.where(keep & F.col("remote_ip").isNotNull()).select("id", "operation", "remote_ip")


def filter_not_in(spark: SparkSession, d: str) -> DataFrame:
    log = access_log(spark, d).withColumn(
        "requester", F.when(F.col("remote_ip") != "-", F.col("requester"))
    )
    inside = F.col("requester").isin(*SITE.internal_requesters)
    return log.where(~F.coalesce(inside, F.lit(False))).select("id", "requester")


def filter_text_affix(spark: SparkSession, d: str) -> DataFrame:
    log = access_log(spark, d).withColumn("table", text.table_of(F.col("key")))
    return log.where(
        ~text.any_affix(F.col("table"), SITE.dropped_prefixes, SITE.dropped_suffixes)
    ).select("id", "table")


def split_key_path(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("key")
    return access_log(spark, d).select(
        "id",
        text.version_of(key).alias("version"),
        text.table_of(key).alias("table"),
        text.object_path_of(key).alias("object_path"),
        text.tag_of(key).alias("tag"),
    )


def classify_usage(spark: SparkSession, d: str) -> DataFrame:
    log = typed_log(access_log(spark, d))
    version = text.version_of(F.col("key"))
    table = text.table_of(F.col("key"))
    return log.select(
        "id",
        F.when(F.contains(table, F.lit("hourly")), "core_hourly.parquet").otherwise(table).alias("table"),
        text.usage_type(F.col("referer"), version, F.col("partition_key"), SITE).alias("usage_type"),
        text.database_of(table).alias("database"),
    )


def replace_all_strings(spark: SparkSession, d: str) -> DataFrame:
    return text.replace_in_strings(
        access_log(spark, d), objectlog.SAME_FORMAT, objectlog.SAME_FORMAT_TEXT
    )


def coerce_numeric(spark: SparkSession, d: str) -> DataFrame:
    return access_log(spark, d).select(
        "id",
        numbers.number_or_null(numbers.dash_to_zero(F.col("bytes_sent"))).alias("bytes_sent"),
        numbers.number_or_null(F.col("object_size"), "bigint").alias("object_size"),
    )


def ratio_and_units(spark: SparkSession, d: str) -> DataFrame:
    return typed_log(access_log(spark, d)).select(
        "id",
        F.round("megabytes_sent", 6).alias("megabytes_sent"),
        F.round("normalized_file_downloads", 6).alias("normalized_file_downloads"),
    )


def composite_id(spark: SparkSession, d: str) -> DataFrame:
    log = access_log(spark, d)
    parts = (F.col("id").cast("string"), F.col("operation"), F.col("key"))
    return log.select("id", text.joined_id(*parts).alias("log_id"))


QUERIES = {
    f.__name__: f
    for f in (
        daily_summary_by_table,
        daily_summary_by_user,
        daily_summary_by_db,
        daily_summaries_at_once,
        summary_late_rows,
        usage_log_build,
        filter_predicates,
        filter_not_in,
        filter_text_affix,
        split_key_path,
        classify_usage,
        replace_all_strings,
        coerce_numeric,
        ratio_and_units,
        composite_id,
    )
}

_MEASURES = """round(sum(normalized_file_downloads), 6) as normalized_file_downloads,
 count(request_uri) as request_count, round(sum(megabytes_sent), 3) as megabytes_sent"""

_CLEAN = "regexp_replace(regexp_replace({0}, 'sqlite.gz', 'sqlite', 'g'), 'sqlite.zip', 'sqlite', 'g') as {0}"

ORACLE = {
    "daily_summary_by_table": f"""{LOG_WITH}
select cast(time as date) as time, usage_type, "table", version, {_MEASURES}
from usage_log where ends_with("table", '.parquet') group by all""",
    "daily_summary_by_user": f"""{LOG_WITH},
joined as (select u.*, cast(time as date) as day, n_name as remote_ip_org,
    'country_' || n_regionkey as remote_ip_country_name
  from usage_log u left join nation
    on cast(split_part(remote_ip, '.', 4) as bigint) % 25 = n_nationkey
  where ends_with("table", '.parquet')),
counted as (select day, remote_ip, "table", remote_ip_org, remote_ip_country_name, usage_type,
    count(*) as n from joined group by all),
modes as (select *, row_number() over (
    partition by day, remote_ip, "table", remote_ip_org, remote_ip_country_name
    order by n desc, usage_type) as rn from counted),
sums as (select day, remote_ip, "table", remote_ip_org, remote_ip_country_name, {_MEASURES}
  from joined group by all)
select s.day as time, s.remote_ip, s."table", s.remote_ip_org, s.remote_ip_country_name,
  s.normalized_file_downloads, s.request_count, s.megabytes_sent, m.usage_type
from sums s join modes m on m.rn = 1 and s.day = m.day
  and s.remote_ip is not distinct from m.remote_ip and s."table" = m."table"
  and s.remote_ip_org is not distinct from m.remote_ip_org
  and s.remote_ip_country_name is not distinct from m.remote_ip_country_name""",
    "daily_summary_by_db": f"""{LOG_WITH}
select cast(time as date) as time, usage_type,
  case when regexp_matches("table", '.parquet') then 'parquet_file' else "table" end as database,
  version, {_MEASURES}
from usage_log where not ends_with("table", '/') group by all""",
    "daily_summaries_at_once": f"""{LOG_WITH},
joined as (select u.* replace (megabytes_sent + 1e-7 as megabytes_sent), cast(time as date) as day, n_name as remote_ip_org
  from usage_log u left join nation on cast(split_part(remote_ip, '.', 4) as bigint) % 25 = n_nationkey),
parquet as (select * from joined where ends_with("table", '.parquet')),
modes as (select *, row_number() over (partition by day, remote_ip, "table", remote_ip_org order by n desc, usage_type) as rn
  from (select day, remote_ip, "table", remote_ip_org, usage_type, count(*) as n from parquet group by all)),
users as (select day, remote_ip, "table", remote_ip_org, {_MEASURES} from parquet group by all)
select 'by_table' as summary, day as time, "table", version, null::varchar as remote_ip, null::varchar as remote_ip_org,
  null::varchar as database, usage_type, {_MEASURES} from parquet group by all
union all
select 'by_user', u.day, u."table", null, u.remote_ip, u.remote_ip_org, null, m.usage_type, u.normalized_file_downloads,
  u.request_count, u.megabytes_sent
from users u join modes m on m.rn = 1 and u.day = m.day and u.remote_ip is not distinct from m.remote_ip
  and u."table" = m."table" and u.remote_ip_org is not distinct from m.remote_ip_org
union all
select 'by_db', day, null, version, null, null,
  case when regexp_matches("table", '.parquet') then 'parquet_file' else "table" end, usage_type, {_MEASURES}
from joined where not ends_with("table", '/') group by all""",
    "summary_late_rows": f"""{LOG_WITH}
select cast(time as date) as time, usage_type, "table", version, {_MEASURES}
from (select * replace (megabytes_sent + 1e-7 as megabytes_sent) from usage_log) where ends_with("table", '.parquet') group by all""",
    "usage_log_build": f"""{LOG_WITH}
select id, time, version, "table", usage_type, remote_ip, key, request_uri, referer, partition_key,
  round(megabytes_sent, 6) as megabytes_sent,
  round(normalized_file_downloads, 6) as normalized_file_downloads from usage_log""",
    "filter_predicates": f"""with {ACCESS_LOG_SQL}, {TYPED_LOG_SQL}
select id, operation, remote_ip from typed_log
where (operation in ('REST.GET.BUCKET', 'REST.GET.OBJECT')
    or operation is distinct from 'S3.TRANSITION_INT.OBJECT')
  and megabytes_sent > 0 and remote_ip is not null""",
    "filter_not_in": f"""with {ACCESS_LOG_SQL},
masked as (select id, case when remote_ip <> '-' then requester end as requester from access_log)
select id, requester from masked where requester is null or requester not in ('user/3', 'user/7')""",
    "filter_text_affix": f"""with {ACCESS_LOG_SQL},
split as (select id, case when strpos(key, '/') > 0 then substr(key, strpos(key, '/') + 1) end as "table"
  from access_log)
select id, "table" from split where "table" is null or not (starts_with("table", 'hourly_old/')
  or ends_with("table", '.js') or ends_with("table", '.log') or ends_with("table", '.csv')
  or ends_with("table", 'env'))""",
    "split_key_path": f"""with {ACCESS_LOG_SQL}
select id, nullif(nullif(split_part(key, '/', 1), '-'), '') as version,
  case when strpos(key, '/') > 0 then substr(key, strpos(key, '/') + 1) end as "table",
  case when strpos(key, '/') > 0 then nullif(substr(key, strpos(key, '/') + 1), '') end as object_path,
  case when strpos(key, '/') > 0 then nullif(rtrim(split_part(key, '/', 1)), '') end as tag
from access_log""",
    "classify_usage": f"""with {ACCESS_LOG_SQL}, {TYPED_LOG_SQL},
split as (select *, case when strpos(key, '/') > 0 then substr(key, strpos(key, '/') + 1) end as tbl,
  nullif(nullif(split_part(key, '/', 1), '-'), '') as version from typed_log)
select id, case when contains(tbl, 'hourly') then 'core_hourly.parquet' else tbl end as "table",
  case when partition_key < '2024-01-16' then 'all'
    when regexp_matches(referer, 'docs.example.org|manual.example.org') then 'docs_link'
    when version = 'viewer-bucket' then 'viewer_duckdb'
    when starts_with(referer, 'https://viewer.example.org/') then 'viewer_link'
    else 'other_s3' end as usage_type,
  case when regexp_matches(tbl, '.parquet') then 'parquet_file' else tbl end as database
from split""",
    "replace_all_strings": f"""with {ACCESS_LOG_SQL}
select id, time, {", ".join(_CLEAN.format(c) for c in
  ("operation", "requester", "remote_ip", "key", "referer", "bytes_sent", "object_size"))}
from access_log""",
    "coerce_numeric": f"""with {ACCESS_LOG_SQL}
select id, try_cast(case when bytes_sent = '-' then '0' else bytes_sent end as double) as bytes_sent,
  try_cast(object_size as bigint) as object_size from access_log""",
    "ratio_and_units": f"""with {ACCESS_LOG_SQL}, {TYPED_LOG_SQL}
select id, round(megabytes_sent, 6) as megabytes_sent,
  round(normalized_file_downloads, 6) as normalized_file_downloads from typed_log""",
    "composite_id": f"""with {ACCESS_LOG_SQL}
select id, cast(id as varchar) || '_' || operation || '_' || key as log_id from access_log""",
}
