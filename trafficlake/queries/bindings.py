"""How the package's inputs are derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.session import tune
from trafficlake.site import Site

SITE = Site(
    internal_requesters=("user/3", "user/7"),
    viewer_referer_prefix="https://viewer.example.org/",
    docs_referer_pattern="docs.example.org|manual.example.org",
    viewer_version="viewer-bucket",
    usage_cutoff="2024-01-16",
    renamed_tables=(("hourly", "core_hourly.parquet"),),
    dropped_prefixes=("hourly_old/",),
    data_paths=("/en", "/fr", ".json", "page=.*ref"),
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The same text is valid in both engines: an object-store access log over `events`.
ACCESS_LOG_COLUMNS = """
 event_id as id, ts as time,
 case event_type when 'view' then 'REST.GET.OBJECT' when 'click' then 'REST.GET.BUCKET'
   when 'purchase' then 'REST.PUT.OBJECT' when 'signup' then 'S3.TRANSITION_INT.OBJECT' end as operation,
 concat('user/', cast(user_id % 10 as varchar(20))) as requester,
 case when user_id % 20 = 0 then '-' else concat('10.0.0.', cast(user_id as varchar(20))) end as remote_ip,
 case when event_id % 5 = 4 then '-' else concat(
   case event_id % 5 when 0 then 'stable' when 1 then 'nightly' when 2 then 'viewer-bucket' else '' end, '/',
   case event_id % 8 when 0 then 'core_a.parquet' when 1 then 'out_b.parquet' when 2 then 'db.sqlite.gz'
     when 3 then 'db.sqlite.zip' when 4 then 'hourly_x.parquet' when 5 then 'hourly_old/p.parquet'
     when 6 then 'app.log' else 'folder/' end) end as key,
 case event_id % 3 when 0 then null when 1 then 'https://viewer.example.org/x'
   else 'https://docs.example.org/y' end as referer,
 case when event_id % 6 = 0 then '-' else cast(cast(round(value * 1000, 0) as bigint) as varchar(20)) end as bytes_sent,
 case when event_id % 11 = 0 then '-' when event_id % 13 = 0 then '0' else '50000' end as object_size
"""

ACCESS_LOG_SQL = f"access_log as (select {ACCESS_LOG_COLUMNS} from events)"


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    columns = []
    depth, start = 0, 0
    for i, ch in enumerate(ACCESS_LOG_COLUMNS):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            columns.append(ACCESS_LOG_COLUMNS[start:i])
            start = i + 1
    columns.append(ACCESS_LOG_COLUMNS[start:])
    return events.selectExpr(*[c.strip() for c in columns])


def typed_log(log: DataFrame) -> DataFrame:
    """The access log with numbers, measures and the columns the usage log needs."""
    from trafficlake.functions import numbers

    sent = numbers.number_or_null(numbers.dash_to_zero(F.col("bytes_sent")))
    size = numbers.number_or_null(F.col("object_size"))
    return log.withColumns(
        {
            "megabytes_sent": numbers.megabytes(sent),
            "normalized_file_downloads": numbers.share(sent, size),
            "object_size": size,
            "request_uri": F.concat(F.lit("GET /"), F.col("key")),
            "partition_key": F.date_format("time", "yyyy-MM-dd"),
            "remote_ip": F.when(F.col("remote_ip") != "-", F.col("remote_ip")),
        }
    ).drop("bytes_sent")


TYPED_LOG_SQL = """typed_log as (select * replace (
   try_cast(object_size as double) as object_size,
   case when remote_ip <> '-' then remote_ip end as remote_ip),
   try_cast(case when bytes_sent = '-' then '0' else bytes_sent end as double) / 1e6 as megabytes_sent,
   case when try_cast(object_size as double) <> 0 then
     try_cast(case when bytes_sent = '-' then '0' else bytes_sent end as double)
       / try_cast(object_size as double) end as normalized_file_downloads,
   'GET /' || key as request_uri,
   strftime(time, '%Y-%m-%d') as partition_key
 from access_log)"""

# usage log: filters, version and table, clean-up, classification
USAGE_LOG_SQL = """usage_split as (
  select *, nullif(nullif(split_part(key, '/', 1), '-'), '') as version,
    case when strpos(key, '/') > 0 then substr(key, strpos(key, '/') + 1) end as tbl
  from typed_log
  where operation in ('REST.GET.BUCKET', 'REST.GET.OBJECT') and megabytes_sent > 0
    and requester not in ('user/3', 'user/7')),
usage_clean as (
  select * replace (
    regexp_replace(regexp_replace(tbl, 'sqlite.gz', 'sqlite', 'g'), 'sqlite.zip', 'sqlite', 'g') as tbl,
    regexp_replace(regexp_replace(key, 'sqlite.gz', 'sqlite', 'g'), 'sqlite.zip', 'sqlite', 'g') as key,
    regexp_replace(regexp_replace(request_uri, 'sqlite.gz', 'sqlite', 'g'), 'sqlite.zip', 'sqlite', 'g') as request_uri)
  from usage_split
  where tbl is null or not (starts_with(tbl, 'hourly_old/') or ends_with(tbl, '.js')
    or ends_with(tbl, '.log') or ends_with(tbl, '.csv') or ends_with(tbl, 'env'))),
usage_log as (
  select id, time, version, remote_ip, megabytes_sent, normalized_file_downloads, object_size,
    key, request_uri, referer, partition_key,
    case when contains(tbl, 'hourly') then 'core_hourly.parquet' else tbl end as "table",
    case when partition_key < '2024-01-16' then 'all'
      when regexp_matches(referer, 'docs.example.org|manual.example.org') then 'docs_link'
      when version = 'viewer-bucket' then 'viewer_duckdb'
      when starts_with(referer, 'https://viewer.example.org/') then 'viewer_link'
      else 'other_s3' end as usage_type
  from usage_clean)"""

LOG_WITH = f"with {ACCESS_LOG_SQL}, {TYPED_LOG_SQL}, {USAGE_LOG_SQL}"
