"""Queries for sources and sinks: partition scans, snapshots, writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators import columns as C
from trafficlake.operators.dedup import keep_first, latest
from trafficlake.operators.joins import new_by_key
from trafficlake.operators.reports import load_report as report
from trafficlake.queries.bindings import read
from trafficlake.schemas import Table, struct_of
from trafficlake.session import checkpoint_folder
from trafficlake.sinks.append import append_new
from trafficlake.sinks.parquet import file_names, read_table, table_path, write_table
from trafficlake.sinks.release import Tables
from trafficlake.sources.tables import day_range, time_range


def scan_partition(spark: SparkSession, d: str) -> DataFrame:
    return day_range(read(spark, d, "events"), "ts", "2024-01-05")


def scan_week_window(spark: SparkSession, d: str) -> DataFrame:
    week = day_range(read(spark, d, "events"), "ts", "2024-01-08", 7)
    return week.select("event_id", F.to_date("ts").alias("day"), "event_type")


def scan_time_range(spark: SparkSession, d: str) -> DataFrame:
    return time_range(read(spark, d, "orders"), "o_orderdate", "1996-02-01", "1997-02-01")


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest(read(spark, d, "events"), order, ["user_id"])


def date_from_text(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("archive/latest-"), F.col("o_orderkey"))
    ).otherwise(
        F.concat(
            F.lit("archive/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"),
            F.col("o_orderkey"), F.lit(".json"),
        )
    )
    found = times.date_in_text(name)
    return read(spark, d, "orders").select(
        "o_orderkey", found.alias("date_text"), F.to_date(found).alias("metrics_date")
    )


def coalesce_legacy_column(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id")
    labels = read(spark, d, "labels").withColumnRenamed("quality", "hash_id")
    joined = docs.join(labels.withColumnRenamed("toxic", "hash_id_legacy"), "doc_id", "left")
    joined = joined.withColumn("fallback", F.lit(-1))
    value = C.coalesce_present(joined, "hash_id", "hash_id_legacy", "not_there", "fallback")
    return joined.select("doc_id", value.alias("hash_id"))


def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    supplier = read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal"
    )
    customer = read(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id")
    )
    return C.union_all(supplier, customer)


HITS = Table(
    "event_hits",
    struct_of("insert_id STRING, timestamp TIMESTAMP, name STRING, score DOUBLE, tags STRING, rank INT, partition_key STRING"),
    ("insert_id",),
)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").withColumnsRenamed(
        {"event_id": "insert_id", "ts": "timestamp", "event_type": "name", "value": "score"}
    )
    day = F.date_format("timestamp", "yyyy-MM-dd")
    return C.conform(events.withColumn("rank", F.col("name").try_cast("int")), HITS, day)


def conform_schema(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d).withColumn("timestamp", times.without_zone(F.col("timestamp")))


class Scratch:
    """A folder for tables that a query writes, gone once its result is checkpointed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = checkpoint_folder(spark)
        if self.root is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        self.path = f"{self.root.rstrip('/')}/query-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` evaluated once and read back."""
        path = f"{self.path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, result: DataFrame) -> DataFrame:
        context = self.spark.sparkContext
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(self.root)
        kept = result.checkpoint()
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        return kept


def scan_stored_partition(spark: SparkSession, d: str) -> DataFrame:
    """One day of a stored, partitioned table: other days are not listed as input."""
    scratch = Scratch(spark)
    write_table(_hits(spark, d), scratch.path, HITS)
    day = read_table(spark, scratch.path, HITS, "2024-01-05", "2024-01-05")
    return scratch.finish(day.select("insert_id", "name", "score", "partition_key"))


def empty_partition(spark: SparkSession, d: str) -> DataFrame:
    """Rows per day of a written table, with an empty day that was written before the first one."""
    scratch = Scratch(spark)
    write_table(_hits(spark, d), scratch.path, HITS, days=["2023-12-31"])
    folder = table_path(scratch.path, HITS.name)
    days = [n.partition("=")[2] for n in file_names(spark, folder) if n.startswith("partition_key=")]
    # the typed empty file is read as any other partition
    none = spark.read.parquet(f"{folder}/partition_key=2023-12-31")
    if none.columns != [c for c in HITS.columns if c != "partition_key"] or none.count():
        raise AssertionError("the empty day was not stored as an empty partition")
    counts = read_table(spark, scratch.path, HITS).groupBy("partition_key").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = spark.createDataFrame([(x,) for x in days], "partition_key string")
    return scratch.finish(
        listed.join(counts, "partition_key", "left").select(
            "partition_key", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
        )
    )


def write_partition_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write all days, write one of them again with other scores, read the table back."""
    scratch = Scratch(spark)
    hits = _hits(spark, d)
    write_table(hits, scratch.path, HITS)
    again = hits.where(F.col("partition_key") == "2024-01-10").withColumn("score", -F.col("score"))
    write_table(again, scratch.path, HITS, days=["2024-01-10", "2024-03-01"])
    stored = read_table(spark, scratch.path, HITS).select("insert_id", "name", "score", "partition_key")
    return scratch.finish(stored)


def append_new_by_key(spark: SparkSession, d: str) -> DataFrame:
    """What an append of all orders adds to a table of the finished ones; a second append adds nothing."""
    scratch = Scratch(spark)
    orders = read(spark, d, "orders")
    target = Table("orders_log", orders.schema, ("o_orderkey",))
    finished = orders.where(F.col("o_orderstatus") == "F")
    append_new(finished, scratch.path, target)
    added = append_new(orders, scratch.path, target)
    again = append_new(orders, scratch.path, target)
    stored = spark.read.parquet(table_path(scratch.path, target.name))
    new = new_by_key(stored, finished, ["o_orderkey"])
    if again or stored.count() != orders.count():
        raise AssertionError(f"{added} rows added, then {again} again")
    return scratch.finish(new)


def published_tables(spark: SparkSession, d: str) -> DataFrame:
    """The rows of ``write_partition_roundtrip`` from two releases; one that fails between its tables changes nothing."""
    scratch, hits = Scratch(spark), _hits(spark, d)
    tables = Tables(spark, scratch.path)
    with tables.begin() as release:
        release.write(hits, HITS)
    again = hits.where(F.col("partition_key") == "2024-01-10").withColumn("score", -F.col("score"))
    with tables.begin() as release:
        release.write(again, HITS, days=["2024-01-10", "2024-03-01"])
    try:
        with tables.begin() as release:
            release.write(again.limit(1), HITS)
            raise InterruptedError
    except InterruptedError:
        pass
    if tables.days(HITS)[-1] != "2024-03-01":
        raise AssertionError("the empty day was not published")
    return scratch.finish(tables.read(HITS).select("insert_id", "name", "score", "partition_key"))


def load_report(spark: SparkSession, d: str) -> DataFrame:
    return report(read(spark, d, "events"), "ts")


def timestamp_normalize(spark: SparkSession, d: str) -> DataFrame:
    zone = F.when(F.col("event_id") % 2 == 0, "+0200]").otherwise("-0730]")
    text = F.date_format("ts", "'['dd/MMM/yyyy:HH:mm:ss")
    at = times.access_log_time(text, zone)
    return read(spark, d, "events").select("event_id", times.without_zone(at).alias("time"))


def unreadable_times(spark: SparkSession, d: str) -> DataFrame:
    """Log lines per day by what their time gives: read, none there, or garbled (which fails a load)."""
    n = F.col("event_id")
    stamp = F.date_format("ts", "'['dd/MMM/yyyy:HH:mm:ss")
    garbled = F.when(n % 7 == 0, F.replace(stamp, F.lit("/"), F.lit("-"))).when(n % 11 == 0, F.lit("-")).otherwise(stamp)
    zone = F.when(n % 13 != 0, "+0000]")
    text, at = times.access_log_text(garbled, zone), times.access_log_time(garbled, zone)
    return read(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(at).alias("n_read"), F.count_if(text.isNull()).alias("n_none"), F.count_if(times.unreadable(text, at)).alias("n_garbled")
    )


def parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    iso = F.when(F.col("event_type") == "error", "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    micros = F.unix_micros(ts.cast("timestamp"))
    day = F.date_format("ts", "yyyy-MM-dd")
    return read(spark, d, "events").select(
        "event_id",
        times.without_zone(times.iso_time(iso)).alias("iso_time"),
        times.iso_date(iso).alias("iso_date"),
        times.without_zone(times.micros_to_time(micros)).alias("micros_time"),
        times.without_zone(times.day_start(day)).alias("day_start"),
    )


def filter_date_window(spark: SparkSession, d: str) -> DataFrame:
    """Weekly snapshots of the last two weeks of daily counts; each keeps its own week."""
    daily = (
        read(spark, d, "events").groupBy(F.to_date("ts").alias("metrics_date"))
        .agg(F.count(F.lit(1)).alias("total_views"))
    )
    monday = F.to_date(F.date_trunc("week", "metrics_date"))
    snapshots = daily.select(
        F.explode(F.array(monday, monday, F.date_add(monday, 7))).alias("partition_day"),
        "metrics_date",
        "total_views",
    )
    once = keep_first(snapshots, ["partition_day", "metrics_date"], [F.col("total_views")])
    day, first = F.col("metrics_date"), F.col("partition_day")
    return once.where(day.between(first, F.date_add(first, 6)))


QUERIES = {
    f.__name__: f
    for f in (
        scan_partition, scan_week_window, scan_time_range, latest_snapshot, date_from_text,
        coalesce_legacy_column, union_by_name, conform_schema, empty_partition,
        scan_stored_partition, write_partition_roundtrip, append_new_by_key, load_report, timestamp_normalize,
        parse_timestamps, filter_date_window, published_tables, unreadable_times,
    )
}

ORACLE = {
    "scan_stored_partition": """select cast(event_id as varchar) as insert_id, event_type as name, value as score,
  strftime(ts, '%Y-%m-%d') as partition_key from events
where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-06'""",
    "scan_partition": """select * from events
where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-06'""",
    "scan_week_window": """select event_id, cast(ts as date) as day, event_type from events
where cast(ts as date) between date '2024-01-08' and date '2024-01-14'""",
    "scan_time_range": """select * from orders
where o_orderdate >= timestamp '1996-02-01' and o_orderdate < timestamp '1997-02-01'""",
    "latest_snapshot": """select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1""",
    "date_from_text": """select o_orderkey,
  case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d') end as date_text,
  case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as metrics_date from orders""",
    "coalesce_legacy_column": """select d.doc_id, coalesce(l.quality, l.toxic, -1) as hash_id
from documents d left join labels l on d.doc_id = l.doc_id""",
    "union_by_name": """select s_suppkey as id, s_name as name, s_acctbal, cast(null as varchar) as segment
from supplier
union all select c_custkey, c_name, null, c_mktsegment from customer""",
    "conform_schema": """select cast(event_id as varchar) as insert_id, ts as timestamp,
  event_type as name, value as score, cast(null as varchar) as tags, cast(null as integer) as rank,
  strftime(ts, '%Y-%m-%d') as partition_key from events""",
    "empty_partition": """select strftime(ts, '%Y-%m-%d') as partition_key, count(*) as n_rows from events group by 1
union all select '2023-12-31', 0""",
    "write_partition_roundtrip": """select cast(event_id as varchar) as insert_id, event_type as name,
  case when cast(ts as date) = date '2024-01-10' then -value else value end as score,
  strftime(ts, '%Y-%m-%d') as partition_key from events""",
    "published_tables": """select cast(event_id as varchar) as insert_id, event_type as name,
  case when cast(ts as date) = date '2024-01-10' then -value else value end as score,
  strftime(ts, '%Y-%m-%d') as partition_key from events""",
    "unreadable_times": """select strftime(ts, '%Y-%m-%d') as day,
  count(*) filter (event_id % 13 <> 0 and event_id % 7 <> 0 and event_id % 11 <> 0) as n_read,
  count(*) filter (event_id % 13 = 0) as n_none,
  count(*) filter (event_id % 13 <> 0 and (event_id % 7 = 0 or event_id % 11 = 0)) as n_garbled
from events group by 1""",
    "append_new_by_key": """select * from orders
where o_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')""",
    "load_report": """select count(*) as n_rows, min(ts) as min_date, max(ts) as max_date from events""",
    "timestamp_normalize": """select event_id, case when event_id % 2 = 0
  then date_trunc('second', ts) - interval 2 hour
  else date_trunc('second', ts) + interval 450 minute end as time from events""",
    "parse_timestamps": """select event_id,
  case when event_type <> 'error' then date_trunc('second', ts) end as iso_time,
  case when event_type <> 'error' then cast(ts as date) end as iso_date,
  ts as micros_time, cast(date_trunc('day', ts) as timestamp) as day_start from events""",
    "filter_date_window": """select cast(date_trunc('week', ts) as date) as partition_day,
  cast(ts as date) as metrics_date, count(*) as total_views from events group by 1, 2""",
}
