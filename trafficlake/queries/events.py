"""Queries for sessions, demux, joins, de-duplication and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.operators import columns as C
from trafficlake.operators import dedup, joins, quality
from trafficlake.operators.enrich import with_ip_details
from trafficlake.operators.sessions import with_sessions
from trafficlake.operators.summaries import mode_per_group as mode_of
from trafficlake.queries.bindings import ACCESS_LOG_SQL, access_log, read
from trafficlake.queries.scans import Scratch
from trafficlake.schemas import Table, struct_of
from trafficlake.streaming.sessions import SessionStore


def sessionize(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").select(
        "event_id", "ts", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    )
    events = events.withColumn("partition_key", F.date_format("ts", "yyyy-MM-dd"))
    return with_sessions(events, "user_id", "ts").select("event_id", "user_id", "session_id")


def sessionize_stream(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of an event stream that brings every third event first, then the others, then some again."""
    scratch = Scratch(spark)
    folder, check = f"{scratch.path}/in", f"{scratch.path}/check"
    user = F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")

    def shaped(events: DataFrame) -> DataFrame:
        return events.select("event_id", "ts", user, F.date_format("ts", "yyyy-MM-dd").alias("partition_key"))

    store = SessionStore(spark, f"{scratch.path}/sessions", ts="ts")
    events = shaped(read(spark, d, "events"))
    for arrives in ("event_id % 3 = 0", "event_id % 3 <> 0", "event_id % 5 = 0"):
        events.where(arrives).write.mode("append").parquet(folder)
        store.merge_available(spark.readStream.schema(events.schema).parquet(folder), check).awaitTermination()
    return scratch.finish(store.with_sessions(events).select("event_id", "user_id", "session_id"))


def event_demux(spark: SparkSession, d: str) -> DataFrame:
    """Five event tables, each with its own columns, put side by side under a tag."""
    wanted = {
        "signup": ["event_id", "ts", "props"],
        "view": ["event_id", "user_id", "ts"],
        "click": ["event_id", "ts", "value"],
        "purchase": ["event_id", "user_id", "ts", "value", "props"],
        "error": ["event_id", "user_id", "ts", "props"],
    }
    return C.demux(read(spark, d, "events"), "event_type", wanted)


def mode_per_group(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    return mode_of(events, ["day", "user_id"], "event_type", "usual_type")


def _ip_records(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = read(spark, d, "customer"), read(spark, d, "nation")
    region = read(spark, d, "region")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, F.col("n_regionkey") == region.r_regionkey, "left"
    )
    return joined.select(
        F.concat(F.lit("10.0.0."), F.col("c_custkey")).alias("ip"),
        F.concat(F.lit("AS"), F.col("c_custkey"), F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(" "))).alias("org"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.when(F.col("n_nationkey") != 3, F.col("c_mktsegment")).alias("country"),
        F.lit(False).alias("isEU"),
    )


def enrich_dimension_join(spark: SparkSession, d: str) -> DataFrame:
    log = access_log(spark, d).select(
        "id", F.when(F.col("remote_ip") != "-", F.col("remote_ip")).alias("remote_ip")
    )
    return with_ip_details(log, _ip_records(spark, d))


def enrich_large_dimension(spark: SparkSession, d: str) -> DataFrame:
    """The same join as for a dimension too large to broadcast: hot addresses apart."""
    log = access_log(spark, d).select(
        "id", F.when(F.col("remote_ip") != "-", F.col("remote_ip")).alias("remote_ip")
    )
    return with_ip_details(log, _ip_records(spark, d), hot_keys=8)


SLUGS = {str(n): f"slug_{n}" for n in range(20)}


def map_lookup_complete(spark: SparkSession, d: str) -> DataFrame:
    customer = read(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("concept")
    )
    known = read(spark, d, "nation").where(F.col("n_nationkey") < 20).select(
        F.col("n_nationkey").cast("string").alias("k")
    )
    missing = quality.unmapped(customer, "concept", known, "k").withColumn("missing", F.lit(True))
    return customer.join(missing, "concept", "left").select(
        "c_custkey",
        joins.map_values(F.col("concept"), SLUGS).alias("slug"),
        F.coalesce("missing", F.lit(False)).alias("missing"),
    )


def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return dedup.keep_first(read(spark, d, "orders"), ["o_custkey"], order)


def dedup_full_row(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events")
    return dedup.distinct_rows(events.unionByName(events))


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return dedup.distinct_values(docs.withColumn("lang", F.nullif("lang", F.lit("fr"))), "lang")


def key_violations(spark: SparkSession, d: str) -> DataFrame:
    lines = quality.key_violations(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = quality.key_violations(read(spark, d, "orders"), ["o_orderkey"])
    return C.union_all(lines, orders.withColumnRenamed("o_orderkey", "l_orderkey"))


def _rules() -> dict:
    return {
        "known event": F.col("event_type").isin("view", "click", "purchase", "signup"),
        "value in range": F.col("value").between(0, 100),
        "readable props": F.from_json("props", "k int")["k"].isNotNull(),
        "small k": F.from_json("props", "k int")["k"] < 90,
    }


def validate_records(spark: SparkSession, d: str) -> DataFrame:
    """Accepted and quarantined records, told apart by the rules they break, which are evaluated once a record."""
    events = quality.judged(read(spark, d, "events"), _rules())
    return events.select("event_id", F.array_join(quality.VIOLATIONS, ", ").alias("broken"))


EVENT_TABLE = Table(
    "typed_events",
    struct_of("event_id BIGINT, kind INT, doi STRING, absent STRING"),
    ("event_id",),
)


def schema_check(spark: SparkSession, d: str) -> DataFrame:
    """Failures per column: a missing one, wrong types, an unmet pattern, unknown columns."""
    doi = F.when(F.col("event_type") == "click", "10.5281/zenodo.1").otherwise(
        F.concat(F.lit("10.5281/zenodo."), F.col("event_type"))
    )
    kind = F.when(F.col("event_type") == "view", "7").otherwise(F.col("event_type"))
    events = read(spark, d, "events").select(
        "event_id", kind.alias("kind"), doi.alias("doi"), F.col("value").alias("extra")
    )
    return quality.schema_check(events, EVENT_TABLE, {"doi": r"10\.5281/zenodo\.\d+"})


QUERIES = {
    f.__name__: f
    for f in (
        sessionize, sessionize_stream, event_demux, mode_per_group, enrich_dimension_join, enrich_large_dimension,
        map_lookup_complete, dedup_keep_first, dedup_full_row, distinct_values, key_violations,
        validate_records, schema_check,
    )
}

_SESSIONS = """with e as (select event_id, ts, strftime(ts, '%Y-%m-%d') as pk,
    case when event_type <> 'error' then user_id end as user_id from events),
f as (select *, case when ts - lag(ts) over (partition by pk, user_id order by ts, event_id)
    > interval 30 minute then 1 else 0 end as flag from e),
n as (select *, sum(flag) over (partition by pk, user_id order by ts, event_id
    rows between unbounded preceding and current row) + 1 as number from f)
select event_id, user_id,
  case when user_id is not null then pk || '-s' || cast(number as bigint) end as session_id from n"""

_ENRICH = f"""with {ACCESS_LOG_SQL},
log as (select id, case when remote_ip <> '-' then remote_ip end as remote_ip from access_log),
ips as (select '10.0.0.' || c_custkey as ip, 'AS' || c_custkey as asn, replace(c_name, '#', ' ') as org,
    n_name as city, r_name as region, case when n_nationkey <> 3 then c_mktsegment end as country
  from customer left join nation on c_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey)
select id, remote_ip, asn as remote_ip_asn, org as remote_ip_org, city as remote_ip_city,
  region as remote_ip_region, country as remote_ip_country,
  city || ', ' || region || ', ' || country as remote_ip_full_location
from log left join ips on remote_ip = ip"""

ORACLE = {
    "sessionize": _SESSIONS,
    "sessionize_stream": _SESSIONS,
    "event_demux": """select event_type as target, event_id,
  ts, case when event_type in ('signup', 'purchase', 'error') then props end as props,
  case when event_type in ('view', 'purchase', 'error') then user_id end as user_id,
  case when event_type in ('click', 'purchase') then value end as value
from events where event_type in ('signup', 'view', 'click', 'purchase', 'error')""",
    "mode_per_group": """with n as (select cast(ts as date) as day, user_id, event_type, count(*) as n
  from events group by all)
select day, user_id, event_type as usual_type from (select *,
  row_number() over (partition by day, user_id order by n desc, event_type) as rn from n) where rn = 1""",
    "enrich_dimension_join": _ENRICH,
    "enrich_large_dimension": _ENRICH,
    "map_lookup_complete": """select c_custkey,
  case when c_nationkey < 20 then 'slug_' || c_nationkey end as slug,
  c_nationkey >= 20 as missing from customer""",
    "dedup_keep_first": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
  from orders) where rn = 1""",
    "dedup_full_row": "select distinct * from events",
    "distinct_values": "select distinct lang from documents where lang <> 'fr'",
    "key_violations": """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
group by 1, 2 having count(*) > 1
union all select o_orderkey, null, count(*) from orders group by 1 having count(*) > 1""",
    "validate_records": """select event_id, concat_ws(', ',
  case when not coalesce(event_type in ('view', 'click', 'purchase', 'signup'), false) then 'known event' end,
  case when not coalesce(value between 0 and 100, false) then 'value in range' end,
  case when not coalesce(regexp_matches(props, '"k": *[0-9]+'), false) then 'readable props' end,
  case when not coalesce(cast(regexp_extract(props, '"k": *([0-9]+)', 1) as integer) < 90, false) then 'small k' end
  ) as broken from events""",
    "schema_check": """select 'kind: type' as rule, count(*) filter (event_type <> 'view') as n_broken,
  count(*) as n_rows from events having n_broken > 0
union all select 'doi: pattern', count(*) filter (event_type <> 'click') as n_broken, count(*) from events
  having n_broken > 0
union all select 'absent: missing', count(*), count(*) from events
union all select 'extra: not registered', count(*), count(*) from events""",
}
