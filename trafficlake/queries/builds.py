"""Whole source plans over records derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators import columns as C
from trafficlake.plans import objectlog, repository, requests, snapshots, viewer
from trafficlake.queries.bindings import ACCESS_LOG_SQL, access_log, read
from trafficlake.queries.events import _ip_records
from trafficlake.queries.scans import Scratch
from trafficlake.schemas import FILTER_SLOTS, table
from trafficlake.site import Site
from trafficlake.sources import files

DAY = "yyyy-MM-dd"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


# Fields of the log that are stored as they are
_LOG_TEXTS = (
    "error_code", "user_agent", "version_id", "host_id", "signature_version", "cipher_suite", "authentication_type",
    "host_header", "tls_version", "access_point_arn", "acl_required",
)


def object_log_build(spark: SparkSession, d: str) -> DataFrame:
    """Access log lines, each delivered twice, to the typed log with address details."""
    dash = F.lit("-")
    log = access_log(spark, d).select(
        F.lit("owner").alias("bucket_owner"),
        F.lit("bucket").alias("bucket"),
        F.date_format("time", "'['dd/MMM/yyyy:HH:mm:ss").alias("time"),
        F.lit("+0000]").alias("timezone"),
        "remote_ip",
        "requester",
        F.concat(F.lit("R"), F.col("id")).alias("request_id"),
        F.coalesce("operation", F.lit("REST.HEAD.OBJECT")).alias("operation"),
        "key",
        F.concat(F.lit("GET /"), F.col("key")).alias("request_uri"),
        F.when(F.col("id") % 4 == 0, dash).otherwise("200").alias("http_status"),
        "bytes_sent",
        "object_size",
        (F.col("id") % 1000).cast("string").alias("total_time"),
        dash.alias("turn_around_time"),
        "referer",
        *[F.lit(f"{c} x").alias(c) for c in _LOG_TEXTS],
        F.date_format("time", DAY).alias("partition_key"),
    )
    again = log.withColumn("aws_region", F.lit("us-west-2"))
    core = objectlog.build_core_s3_logs(
        log.unionByName(again, allowMissingColumns=True), _ip_records(spark, d)
    )
    return _zoneless(core).withColumn("normalized_file_downloads", F.round("normalized_file_downloads", 6))


def _viewer_lines(spark: SparkSession, d: str, all_kinds: bool = False) -> DataFrame:
    """Viewer log records, some of them broken, parsed from JSON lines; ``all_kinds``: of all six tables."""
    event_id, kind = F.col("event_id"), F.col("event_type")
    at = F.date_format("ts", ISO)
    filters = F.transform(
        F.sequence(F.lit(1), F.lit(8)),
        lambda i: F.struct(
            F.concat(F.lit("f"), i).alias("fieldName"),
            F.when(event_id % 101 == 0, "odd").otherwise("number").alias("fieldType"),
            F.lit("equals").alias("operation"),
            (event_id + i).alias("value"),
        ),
    )
    params = F.struct(
        F.lit("t").alias("name"),
        F.when(event_id % 7 > 0, F.lit(1)).alias("page"),
        F.lit(100).alias("perPage"),
        F.to_json(F.slice(filters, F.lit(1), (event_id % 9).cast("int"))).alias("filters"),
    )
    name = (
        F.when(kind == "view", "search").when(kind == "click", "hit")
        .when(kind == "purchase", "duckdb_preview").when(kind == "signup", "loading")
    )
    if all_kinds:
        name = F.when((kind == "purchase") & (event_id % 2 == 1), "duckdb_csv").when(
            (kind == "signup") & (event_id % 2 == 0), "privacy-policy").otherwise(name)
    user = F.col("user_id") % 10 > 0
    payload = F.struct(
        name.alias("event"),
        F.when(event_id % 50 > 0, at).otherwise("never").alias("timestamp"),
        F.when(user, F.concat(F.lit("u"), F.col("user_id"))).alias("userId"),
        F.when(user, F.concat(F.lit("d"), F.col("user_id") % 5)).alias("userDomain"),
        F.when(kind == "view", F.concat(F.lit("q "), event_id)).alias("query"),
        F.when(kind != "click", F.concat(F.lit("/u/"), event_id)).alias("url"),
        F.when(kind == "click", F.col("value")).alias("score"),
        F.when(kind == "click", F.concat(F.lit("n"), event_id)).alias("name"),
        F.when(kind == "click", F.lit("a,b")).alias("tags"),
        *[F.when(kind == "signup", event_id % n == 0).alias(c) for c, n in (("accepted", 3), ("newsletter", 4), ("outreach", 5))],
        F.when(kind == "purchase", params).alias("params"),
    )
    line = F.to_json(
        F.struct(
            event_id.cast("string").alias("insertId"), F.lit("log").alias("logName"),
            at.alias("receiveTimestamp"), at.alias("timestamp"),
            F.when(kind == "error", F.concat(F.lit("/callback?next=/search?q%3Dk+"), event_id)).alias("textPayload"),
            F.create_map(F.lit("a"), F.lit("b")).alias("labels"),
            F.struct(F.lit("t").alias("type")).alias("resource"),
            F.when(kind != "error", payload).alias("jsonPayload"),
        )
    )
    options = {"columnNameOfCorruptRecord": "unreadable"}
    # through a generator, so that a line is parsed once however many rules look at it
    return read(spark, d, "events").select(
        F.date_format("ts", DAY).alias("partition_key"),
        F.inline(F.array(F.from_json(line, files.VIEWER_LOG, options))),
    )


def viewer_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Records read, accepted and rejected per day, judged in one parse; the two kinds add up to all."""
    records = viewer.judged(_viewer_lines(spark, d))
    broken = F.size("violations") > 0
    return records.groupBy("partition_key").agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(~broken).alias("n_accepted"),
        F.count_if(broken).alias("n_rejected"),
    )


def viewer_events_build(spark: SparkSession, d: str) -> DataFrame:
    """JSON log lines through validation, flattening, log-in marking and sessions."""
    scratch = Scratch(spark)
    events = viewer.events_of(scratch.keep(viewer.judged(_viewer_lines(spark, d))))
    return scratch.finish(events.select(
        "insert_id", "event", "user_id", "score", "params_page", "params_filters_value",
        "params_filters_field_name_6", "params_filters", "log_in_query", "session_id",
    ))


def _zoneless(df: DataFrame) -> DataFrame:
    """All columns, instants as wall-clock times."""
    return df.select(*[times.without_zone(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


def viewer_tables_build(spark: SparkSession, d: str) -> DataFrame:
    """All rows and columns of the six event tables, from one parse of the log that is staged by kind, as a load does it."""
    scratch = Scratch(spark)
    events = viewer.events_of(scratch.keep(viewer.judged(_viewer_lines(spark, d, all_kinds=True))))
    events.write.partitionBy("event").parquet(f"{scratch.path}/events")
    staged = spark.read.schema(events.schema).parquet(f"{scratch.path}/events")
    frames = [df.withColumn("target", F.lit(name.removeprefix("core_viewer_"))) for name, df in viewer.build_event_tables(staged).items()]
    return scratch.finish(_zoneless(C.union_all(*frames)))


def _daily(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    return read(spark, d, "events").groupBy(F.to_date("ts").alias("day"), *keys).agg(
        F.count(F.lit(1)).cast("int").alias("count"), F.max("user_id").cast("int").alias("uniques")
    )


def traffic_series_build(spark: SparkSession, d: str) -> DataFrame:
    """Weekly snapshots that each repeat the week before, to one row per day."""
    monday = F.to_date(F.date_trunc("week", "day"))
    weeks = F.array(*[w.cast("string") for w in (monday, monday, F.date_add(monday, 7))])
    raw = _daily(spark, d).select(
        F.explode(weeks).alias("partition_key"),
        F.date_format("day", "yyyy-MM-dd'T'00:00:00'Z'").alias("timestamp"), "count", "uniques",
    )
    return repository.build_series(raw, "core_github_views")


def popular_build(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("day").cast("string")
    raw = _daily(spark, d, "event_type").select(
        F.col("event_type").alias("referrer"), "count", "uniques",
        day.alias("metrics_date"), day.alias("partition_key"),
    )
    return repository.build_popular(raw, "core_github_popular_referrers")


def _json_rows(rows: DataFrame, record: Column, schema: str) -> DataFrame:
    return rows.select(F.from_json(F.to_json(record), schema).alias("r")).select("r.*")


# Values of a record field by its stored type, in text that both engines read
def _values(name: str, given: dict[str, str]) -> dict[str, str]:
    """A value for each column of a table, ``given`` ones first."""
    key, out = "c_custkey", {}
    for i, field in enumerate(table(name).schema.fields):
        by_type = {
            "string": f"concat('{field.name} ', cast({key} as varchar(20)))",
            "integer": f"cast(({key} * {i + 1}) % 1000 as int)",
            "boolean": f"({key} + {i}) % 3 = 0",
            "timestamp": f"'2024-05-{i % 28 + 1:02d}T10:00:00Z'",
        }
        out[field.name] = given.get(field.name, by_type[field.dataType.typeName()])
    return out


def _values_sql(name: str, values: dict[str, str], stored: dict[str, str]) -> str:
    """What those values are stored as."""
    times_of = {
        f.name: f"cast(replace(replace({values[f.name]}, 'T', ' '), 'Z', '') as timestamp)"
        for f in table(name).schema.fields if f.dataType.typeName() == "timestamp"
    }
    shown = {**values, **times_of, **stored}
    return ", ".join(f"{v} as {c}" for c, v in shown.items())


_STARGAZER = _values("core_github_stargazers", {"id": "cast(c_custkey as int)"})
_FORK = _values("core_github_forks", {
    "id": "cast(c_custkey as int)", "pushed_at": "cast(null as varchar(20))", "license": "cast(null as varchar(20))",
})


def stargazers_build(spark: SparkSession, d: str) -> DataFrame:
    user = F.struct(
        *[F.expr(v).alias(c) for c, v in _STARGAZER.items() if c != "starred_at"],
        F.lit("x").alias("gravatar_id"), F.lit("y").alias("avatar_url"),
    )
    record = F.struct(F.expr(_STARGAZER["starred_at"]).alias("starred_at"), user.alias("user"))
    raw = _json_rows(read(spark, d, "customer"), record, files.STARGAZERS)
    return _zoneless(repository.build_stargazers(raw.select("user.*", "starred_at")))


def forks_build(spark: SparkSession, d: str) -> DataFrame:
    nested_fields = {"owner": F.struct(F.col("c_name").alias("login")), "topics": F.array("c_mktsegment")}
    plain = {("size" if c == "size_kb" else c): v for c, v in _FORK.items() if c not in nested_fields}
    record = F.struct(
        *[F.expr(v).alias(c) for c, v in plain.items()], *[v.alias(c) for c, v in nested_fields.items()],
        F.lit(True).alias("fork"), F.lit("u").alias("html_url"), F.lit(1).alias("open_issues_count"),
    )
    return _zoneless(repository.build_forks(_json_rows(read(spark, d, "customer"), record, files.FORKS)))


def dataset_snapshot_build(spark: SparkSession, d: str) -> DataFrame:
    """One snapshot per customer and day, in the three layouts in turn."""
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    day = F.date_add(F.lit("2000-01-01").cast("date"), key.cast("int")).cast("string")
    start = F.concat(F.lit('{"metrics_date": "'), day, F.lit('", '))
    nested_doc = F.concat(
        start, F.lit('"datasetSlug": "not here", "info": {"datasetSlug": "slug", "ownerUserNullable": "owner", "totalViews": 0, "totalViewsNullable": '),
        F.when(n > 5, n.cast("string")).otherwise("null"), F.lit(', "hasTotalViews": '),
        (n > 5).cast("string"), F.lit(', "titleNullable": "'), F.col("c_name"), F.lit('", "isPrivate": true}}'),
    )
    flat_doc = F.concat(
        start, F.lit('"usabilityRating": 0.75, "subtitle": "sub", "datasetId": 7, "totalVotes": 3, "totalViews": '),
        n.cast("string"), F.lit(', "title": "'), F.col("c_name"), F.lit('"}')
    )
    dotted_doc = F.concat(
        start, F.lit('"info.totalViews": '), n.cast("string"), F.lit(', "info.title": "'),
        F.col("c_name"), F.lit('", "info.keywords": ["k"], "info.description": "text", "info.totalDownloads": '), n.cast("string"),
        F.lit(', "info.licenses": [{"name": "l"}], "info.data": [], "info.collaborators": [{"username": "c"}]}'),
    )
    doc = F.when(key % 3 == 0, nested_doc).when(key % 3 == 1, flat_doc).otherwise(dotted_doc)
    raw = read(spark, d, "customer").select(
        F.from_json(doc, files.snapshot_schema()).alias("r"), day.alias("partition_key")
    )
    return _zoneless(snapshots.build_core_kaggle_logs(raw.select("r.*", "partition_key")))


def archive_stats_build(spark: SparkSession, d: str) -> DataFrame:
    """Two records per document, in the two partitions whose windows hold its day."""
    key = F.col("p_partkey")

    def record(version: Column, swh: Column) -> Column:
        stats = {
            "downloads": 1, "unique_downloads": 2, "views": 3, "unique_views": 4,
            "version_downloads": 5, "version_unique_downloads": 6, "version_views": 7, "version_unique_views": 8,
        }
        return F.struct(
            version.alias("id"), version.cast("string").alias("recid"), F.lit("4127026").alias("conceptrecid"), F.col("p_name").alias("title"),
            F.struct(
                F.lit("2024-12-31").alias("publication_date"), F.col("p_brand").alias("version"), F.col("p_type").alias("description")
            ).alias("metadata"),
            F.struct(*[(F.col("p_size") * n).alias(c) for c, n in stats.items()]).alias("stats"), swh.alias("swh"),
            *[F.concat(F.lit(f"{c} "), version).alias(c) for c in ("doi", "conceptdoi", "doi_url", "status", "state")],
            (version % 2 == 0).alias("submitted"),
            *[F.lit(f"2025-01-0{i}T0{i}:00:00.500000+00:00").alias(c) for i, c in enumerate(("created", "modified", "updated"), 1)],
        )

    records = F.array(
        record(key * 2, F.lit('{"swhid": "old"}')),
        record(key * 2 + 1, F.when(key % 2 == 0, F.lit("new"))),
    )
    doc = F.to_json(F.struct(F.struct(records.alias("hits")).alias("hits")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string")
    docs = read(spark, d, "part").select(
        F.from_json(doc, files.ARCHIVE_STATS)["hits"].alias("hits"), day.alias("partition_key")
    )
    return _zoneless(snapshots.build_core_zenodo_logs(files.archive_records(docs, 2), Site()))


def client_log_build(spark: SparkSession, d: str) -> DataFrame:
    """Storage usage rows to downloads by the Python client."""
    log = access_log(spark, d).select(
        F.unix_micros(F.col("time").cast("timestamp")).alias("time_micros"),
        F.when(F.col("remote_ip") != "-", F.col("remote_ip")).alias("c_ip"),
        F.lit(1).alias("c_ip_type"), F.lit(None).cast("string").alias("c_ip_region"),
        F.lit("GET").alias("cs_method"), F.lit(200).alias("sc_status"),
        F.when(F.col("id") % 3 > 0, "Python-urllib/3.9").otherwise("curl").alias("cs_user_agent"),
        F.col("id").cast("string").alias("s_request_id"),
        F.when(F.col("operation") == "REST.GET.OBJECT", "storage.objects.get").otherwise("storage.objects.list").alias("cs_operation"),
        F.col("key").alias("cs_object"),
    )
    out = requests.build_intake_logs(log, _ip_records(spark, d), "2024-01-01")
    return _zoneless(out)


QUERIES = {
    f.__name__: f
    for f in (
        object_log_build, viewer_rejected, viewer_events_build, viewer_tables_build, traffic_series_build,
        popular_build, stargazers_build, forks_build, dataset_snapshot_build,
        archive_stats_build, client_log_build,
    )
}

_IPS = """ips as (select '10.0.0.' || c_custkey as ip, 'AS' || c_custkey as asn, replace(c_name, '#', ' ') as org,
    n_name as city, r_name as region, case when n_nationkey <> 3 then c_mktsegment end as country,
    n_name || ', ' || r_name || ', ' || case when n_nationkey <> 3 then c_mktsegment end as location
  from customer left join nation on c_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey)"""

def _slots_sql() -> str:
    """The filter slots of a record with ``event_id % 9`` filters."""
    out = []
    for i in range(FILTER_SLOTS):
        suffix = f"_{i}" if i else ""
        for part, value in (("field_name", f"'f{i + 1}'"), ("field_type", "'number'"), ("operation", "'equals'"), ("value", f"cast(event_id + {i + 1} as varchar)")):
            out.append(f"case when event_type = 'purchase' and event_id % 9 > {i} then {value} end as params_filters_{part}{suffix}")
    return ",\n    ".join(out)


_VIEWER_TABLES = f"""with kept as (select *, strftime(ts, '%Y-%m-%d') as partition_key,
    (event_type = 'signup' and event_id % 2 = 1) or (event_type = 'purchase' and event_id % 7 = 0) as dropped from events),
flat as (select event_id, ts as timestamp, partition_key, cast(event_id as varchar) as insert_id,
    case event_type when 'view' then 'searches' when 'click' then 'hits'
      when 'purchase' then case when event_id % 2 = 1 then 'downloads' else 'previews' end
      when 'signup' then 'user_settings_updates' when 'error' then 'log_ins' end as target,
    case when event_type <> 'error' and user_id % 10 > 0 then 'u' || user_id end as user_id,
    case when event_type <> 'error' and user_id % 10 > 0 then 'd' || user_id % 5 end as user_domain,
    case when event_type = 'view' then 'q ' || event_id end as query,
    case when event_type in ('view', 'purchase') then '/u/' || event_id end as url,
    case when event_type = 'click' then value end as score,
    case when event_type = 'click' then 'n' || event_id end as name, case when event_type = 'click' then 'a,b' end as tags,
    case when event_type = 'signup' then event_id % 3 = 0 end as accepted,
    case when event_type = 'signup' then event_id % 4 = 0 end as newsletter,
    case when event_type = 'signup' then event_id % 5 = 0 end as outreach,
    case when event_type = 'purchase' then 't' end as params_name,
    case when event_type = 'purchase' then cast(1 as int) end as params_page,
    case when event_type = 'purchase' then cast(100 as int) end as params_per_page,
    {_slots_sql()},
    case when event_type = 'purchase' then '[' || array_to_string(list_transform(range(1, event_id % 9 + 1),
      lambda i: '{{"fieldName":"f' || i || '","fieldType":"number","operation":"equals","value":' || (event_id + i) || '}}'),
      ',') || ']' end as params_filters,
    case when event_type = 'error' then '/callback?next=/search?q%3Dk+' || event_id end as text_payload,
    case when event_type = 'error' then 'k ' || event_id end as log_in_query
  from kept where not dropped
    and (event_type = 'error' or (event_id % 50 > 0
      and not (event_type = 'purchase' and event_id % 9 > 0 and event_id % 101 = 0)))),
gaps as (select *, case when timestamp - lag(timestamp) over (partition by partition_key, user_id order by timestamp, event_id)
    > interval 30 minute then 1 else 0 end as gap from flat),
numbered as (select *, 1 + sum(gap) over (partition by partition_key, user_id order by timestamp, event_id
    rows between unbounded preceding and current row) as number from gaps)
select * exclude (event_id, gap, number, user_id, user_domain),
  case when target not in ('hits', 'log_ins') then user_id end as user_id,
  case when target not in ('hits', 'log_ins') then user_domain end as user_domain,
  case when user_id is not null and target in ('searches', 'previews', 'downloads')
    then partition_key || '-s' || cast(number as bigint) end as session_id
from numbered where target <> 'user_settings_updates' or user_id is not null"""

_IP_COLUMNS = {
    "remote_ip_city": "city", "remote_ip_region": "region", "remote_ip_country": "country", "remote_ip_asn": "asn",
    "remote_ip_org": "org", "remote_ip_full_location": "location",
}


def _stored_sql(name: str, given: dict[str, str]) -> str:
    """All columns of a table: those given, the others typed NULLs."""
    kinds = {"string": "varchar", "int": "integer"}
    return ", ".join(
        f"{given[f.name]} as {f.name}" if f.name in given else f"cast(null as {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}) as {f.name}"
        for f in table(name).schema.fields
    )


ORACLE = {
    "object_log_build": f"""with {ACCESS_LOG_SQL}, {_IPS},
typed as (select 'R' || id || '_' || coalesce(operation, 'REST.HEAD.OBJECT') || '_' || key as id, 'R' || id as request,
    coalesce(operation, 'REST.HEAD.OBJECT') as asked, key, requester, referer,
    date_trunc('second', time) as time,
    cast(case when bytes_sent = '-' then '0' else bytes_sent end as double) as sent,
    try_cast(object_size as double) as object_size,
    case when id % 4 > 0 then 200 end as http_status, id % 1000 as total_time,
    case when remote_ip <> '-' then remote_ip end as remote_ip, strftime(time, '%Y-%m-%d') as partition_key
  from access_log where operation is distinct from 'S3.TRANSITION_INT.OBJECT')
select {_stored_sql("core_s3_logs", {
    **{c: f"typed.{c}" for c in ("id", "time", "key", "requester", "referer", "http_status", "object_size", "total_time", "remote_ip", "partition_key")},
    **_IP_COLUMNS, **{c: f"'{c} x'" for c in _LOG_TEXTS},
    "request_uri": "'GET /' || typed.key", "operation": "asked", "bucket": "'bucket'", "bucket_owner": "'owner'", "request_id": "request",
    "megabytes_sent": "sent / 1e6", "normalized_file_downloads": "case when object_size <> 0 then round(sent / object_size, 6) end",
})}
from typed left join ips on remote_ip = ip""",
    "viewer_rejected": """with judged as (select strftime(ts, '%Y-%m-%d') as partition_key,
    event_type not in ('error', 'signup') and not (event_type = 'purchase' and event_id % 7 = 0)
    and (event_id % 50 = 0 or (event_type = 'purchase' and event_id % 9 > 0 and event_id % 101 = 0)) as bad
  from events)
select partition_key, count(*) as n_read, count(*) filter (not bad) as n_accepted,
  count(*) filter (bad) as n_rejected from judged group by 1""",
    "viewer_events_build": """with kept as (select *, strftime(ts, '%Y-%m-%d') as pk,
    event_type = 'signup' or (event_type = 'purchase' and event_id % 7 = 0) as dropped from events),
flat as (select event_id, ts, pk,
    case event_type when 'view' then 'search' when 'click' then 'hit' when 'purchase' then 'duckdb_preview'
      when 'error' then 'log_in' end as event,
    case when event_type <> 'error' and user_id % 10 > 0 then 'u' || user_id end as user_id,
    case when event_type = 'click' then value end as score,
    case when event_type = 'purchase' then 1 end as params_page,
    case when event_type = 'purchase' and event_id % 9 > 0 then cast(event_id + 1 as varchar) end as params_filters_value,
    case when event_type = 'purchase' and event_id % 9 > 6 then 'f7' end as params_filters_field_name_6,
    case when event_type = 'purchase' then '[' || array_to_string(list_transform(range(1, event_id % 9 + 1),
      lambda i: '{"fieldName":"f' || i || '","fieldType":"number","operation":"equals","value":' || (event_id + i) || '}'),
      ',') || ']' end as params_filters,
    case when event_type = 'error' then 'k ' || event_id end as log_in_query
  from kept where not dropped
    and (event_type = 'error' or (event_id % 50 > 0
      and not (event_type = 'purchase' and event_id % 9 > 0 and event_id % 101 = 0)))),
gaps as (select *, case when ts - lag(ts) over (partition by pk, user_id order by ts, event_id)
    > interval 30 minute then 1 else 0 end as gap from flat),
numbered as (select *, 1 + sum(gap) over (partition by pk, user_id order by ts, event_id
    rows between unbounded preceding and current row) as number from gaps)
select cast(event_id as varchar) as insert_id, event, user_id, score, params_page, params_filters_value,
  params_filters_field_name_6, params_filters, log_in_query,
  case when user_id is not null then pk || '-s' || cast(number as bigint) end as session_id from numbered""",
    "viewer_tables_build": _VIEWER_TABLES,
    "traffic_series_build": """select cast(ts as date) as metrics_date, cast(count(*) as integer) as total_views,
  cast(max(user_id) as integer) as unique_views,
  strftime(date_trunc('week', cast(ts as date)), '%Y-%m-%d') as partition_key
from events group by 1, 4""",
    "popular_build": """select cast(ts as date) as metrics_date, event_type as referrer,
  cast(count(*) as integer) as total_referrals, cast(max(user_id) as integer) as unique_referrals,
  strftime(cast(ts as date), '%Y-%m-%d') as partition_key from events group by 1, 2, 5""",
    "stargazers_build": f"select {_values_sql('core_github_stargazers', _STARGAZER, {})} from customer",
    "forks_build": "select {} from customer".format(_values_sql("core_github_forks", _FORK, {
        "owner": """'{"login":"' || c_name || '"}'""", "topics": """'["' || c_mktsegment || '"]'""",
    })),
    "dataset_snapshot_build": """select cast(date '2000-01-01' + cast(c_custkey as integer) as timestamp) as metrics_date,
  case when c_custkey % 3 > 0 or c_nationkey > 5 then c_nationkey end as total_views,
  case when c_custkey % 3 = 2 then c_nationkey end as total_downloads,
  case when c_custkey % 3 = 1 then cast(3 as int) end as total_votes, case when c_custkey % 3 = 1 then cast(0.75 as double) end as usability_rating,
  case when c_custkey % 3 = 0 then 'slug' end as dataset_name, case when c_custkey % 3 = 0 then 'owner' end as owner, c_name as title,
  case when c_custkey % 3 = 1 then 'sub' end as subtitle, case when c_custkey % 3 = 2 then 'text' end as description,
  case when c_custkey % 3 = 2 then '["k"]' end as keywords, case when c_custkey % 3 = 1 then '7' end as dataset_id,
  case when c_custkey % 3 = 0 then 'True' end as is_private, case when c_custkey % 3 = 2 then '[{"name":"l"}]' end as licenses,
  case when c_custkey % 3 = 2 then '[{"username":"c"}]' end as collaborators, case when c_custkey % 3 = 2 then '[]' end as data,
  strftime(date '2000-01-01' + cast(c_custkey as integer), '%Y-%m-%d') as partition_key from customer""",
    "archive_stats_build": """with r as (
  select *, cast(p_partkey * 2 + which as integer) as v
  from part, (values (0), (1)) w(which), (values (0), (1)) b(back))
select date '2024-01-01' + p_size as metrics_date, p_brand as version, 'eia860' as dataset_slug, p_size as dataset_downloads,
  p_size * 2 as dataset_unique_downloads, p_size * 3 as dataset_views, p_size * 4 as dataset_unique_views,
  p_size * 5 as version_downloads, p_size * 6 as version_unique_downloads, p_size * 7 as version_views, p_size * 8 as version_unique_views,
  p_name as version_title, v as version_id, v as version_record_id, 4127026 as concept_record_id,
  timestamp '2025-01-01 01:00:00.5' as version_creation_date, timestamp '2025-01-02 02:00:00.5' as version_last_modified_date,
  timestamp '2025-01-03 03:00:00.5' as version_last_updated_date, date '2024-12-31' as version_publication_date,
  'doi ' || v as version_doi, 'conceptdoi ' || v as concept_record_doi, 'doi_url ' || v as version_doi_url,
  'status ' || v as version_status, 'state ' || v as version_state, v % 2 = 0 as version_submitted, p_type as version_description,
  strftime(date '2024-01-01' + p_size - back, '%Y-%m-%d') as partition_key,
  case when which = 0 then 'old' when p_partkey % 2 = 0 then 'new' end as software_hash_id
from r""",
    "client_log_build": f"""with {ACCESS_LOG_SQL}, {_IPS}
select {_stored_sql("intake_logs", {
    **_IP_COLUMNS, "insert_id": "cast(id as varchar)", "timestamp": "time",
    "remote_ip": "case when remote_ip <> '-' then remote_ip end", "remote_ip_type": "'1'", "request_method": "'GET'",
    "response_status": "cast(200 as integer)", "request_user_agent": "'Python-urllib/3.9'", "request_operation": "'storage.objects.get'",
    "request_object": "key", "partition_key": "'2024-01-01'",
    "tag": "case when strpos(key, '/') > 0 then nullif(split_part(key, '/', 1), '') end",
    "object_path": "case when strpos(key, '/') > 0 then nullif(substr(key, strpos(key, '/') + 1), '') end",
})}
from access_log left join ips on remote_ip = ip where id % 3 > 0 and operation = 'REST.GET.OBJECT'""",
}
