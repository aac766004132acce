"""The file readers over files that Spark writes from the driver tables: logs, JSON lines, JSON documents, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.queries.bindings import read
from trafficlake.queries.scans import Scratch
from trafficlake.sinks.parquet import file_names
from trafficlake.sources import files

DAYS = ("2024-01-05", "2024-01-06", "2024-01-07")


def _place(spark: SparkSession, lines: DataFrame, target: str, name: str, mode: str = "text") -> None:
    """Write ``lines`` (day, value) with one file a day, or one folder of files, named after the day.

    ``name`` is the path of a day's file or folder below ``target``, with ``{day}`` for the day.
    """
    staged = f"{target}-written"
    lines.repartition("day").write.partitionBy("day").text(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in sorted(f for f in file_names(spark, staged) if f.startswith("day=")):
        to = path(f"{target}/{name.format(day=folder[4:])}")
        system.mkdirs(to.getParent())
        parts = [f for f in file_names(spark, f"{staged}/{folder}") if f.startswith("part-")]
        source = f"{staged}/{folder}" if mode == "folder" else f"{staged}/{folder}/{parts[0]}"
        if not system.rename(path(source), to):
            raise OSError(f"{source} could not be moved")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


def read_object_log(spark: SparkSession, d: str) -> DataFrame:
    """Three days of a space-delimited log with quoted fields; lines of odd ids have the younger, longer layout."""
    scratch, n = Scratch(spark), F.col("event_id").cast("string")
    dash = F.lit("-")
    fields = [
        F.lit("owner"), F.lit("bucket"), F.date_format("ts", "'['dd/MMM/yyyy:HH:mm:ss"), F.lit("+0000]"), F.lit("10.0.0.1"), dash,
        F.concat(F.lit("R"), n), F.lit("REST.GET.OBJECT"), F.concat(F.lit("stable/"), F.col("event_type")),
        F.concat(F.lit('"GET /'), n, F.lit(' HTTP/1.1"')), F.lit("200"), dash, F.lit("7"), dash, n, dash, F.lit('"-"'),
        F.concat(F.lit('"Agent ""quoted"" '), n, F.lit('"')), *[F.lit(f"f{i}") for i in range(9)],
    ]
    line = F.concat_ws(" ", *fields)
    lines = F.when(F.col("event_id") % 2 == 1, F.concat(line, F.lit(" us-west-2"))).otherwise(line)
    events = _events(spark, d).where(F.col("event_type").isNotNull())
    _place(spark, events.select("day", lines.alias("value")), f"{scratch.path}/log", "{day}-00-00")
    spark.createDataFrame([], "value string").write.text(f"{scratch.path}/log/{DAYS[0]}-empty")
    rows = files.object_log(spark, f"{scratch.path}/log", DAYS)
    at = times.access_log_time(F.col("time"), F.col("timezone"))
    return scratch.finish(rows.select(
        "request_id", "key", "request_uri", "user_agent", "total_time", "acl_required", "aws_region",
        times.without_zone(at).alias("time"), "partition_key",
    ))


def read_viewer_log(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines in a folder a day, read for three days; every hundredth line is cut off."""
    scratch, n = Scratch(spark), F.col("event_id")
    payload = F.struct(F.col("event_type").alias("event"), F.col("value").alias("score"), F.struct(F.lit(2).alias("page")).alias("params"))
    line = F.to_json(F.struct(n.cast("string").alias("insertId"), F.lit("t").alias("textPayload"), payload.alias("jsonPayload")))
    line = F.when(n % 100 == 0, F.substring(line, 1, 12)).otherwise(line)
    _place(spark, _events(spark, d).select(F.replace("day", F.lit("-"), F.lit("_")).alias("day"), line.alias("value")), f"{scratch.path}/raw", "{day}", "folder")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(scratch.path).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in file_names(spark, f"{scratch.path}/raw"):
        to = path(f"{scratch.path}/log/{day.replace('_', '/')}")
        system.mkdirs(to.getParent())
        system.rename(path(f"{scratch.path}/raw/{day}"), to)
    rows = files.viewer_log(spark, f"{scratch.path}/log", DAYS)
    return scratch.finish(rows.select(
        "insertId", "textPayload", F.col("jsonPayload.event").alias("event"), F.col("jsonPayload.score").alias("score"),
        F.col("jsonPayload.params.page").alias("page"), "unreadable", "partition_key",
    ).withColumnsRenamed({"insertId": "insert_id", "textPayload": "text_payload"}))


def _array(rows: DataFrame, record: Column) -> DataFrame:
    """(day, value): one JSON array a day."""
    listed = rows.groupBy("day").agg(F.sort_array(F.collect_list(F.to_json(record))).alias("records"))
    return listed.select("day", F.concat(F.lit("["), F.array_join("records", ",\n"), F.lit("]")).alias("value"))


def read_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are an array, one a day: the wanted days of referrers, and the newest of stargazers."""
    scratch = Scratch(spark)
    counts = _events(spark, d).groupBy("day", F.col("event_type").alias("referrer")).agg(
        F.count(F.lit(1)).cast("int").alias("count"), F.max("user_id").cast("int").alias("uniques")
    )
    _place(spark, _array(counts, F.struct("referrer", "count", "uniques")), f"{scratch.path}/referrers", "{day}.json")
    popular = files.popular(spark, f"{scratch.path}/referrers", "popular_referrers", DAYS)
    customers = read(spark, d, "customer")
    user = F.struct(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("login"))
    record = F.struct(F.lit("2024-05-01T10:00:00Z").alias("starred_at"), user.alias("user"))
    for k, rows in (("a", customers.where("c_custkey % 2 = 0")), ("b", customers)):
        _place(spark, _array(rows.withColumn("day", F.lit(k)), record), f"{scratch.path}/stars-{k}", "{day}.json")
    # the newer file is the one that counts
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(scratch.path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{scratch.path}/stars"))
    for k in "ab":
        to = path(f"{scratch.path}/stars/2024-0{2 - 'ab'.index(k)}-01.json")
        system.rename(path(f"{scratch.path}/stars-{k}/{k}.json"), to)
        system.setTimes(to, 1_700_000_000_000 + 1000 * "ab".index(k), -1)
    stars = files.stargazers(spark, f"{scratch.path}/stars")
    return scratch.finish(
        popular.select("metrics_date", F.col("referrer").alias("name"), F.col("count").alias("n"), "uniques").unionByName(
            stars.select(F.col("starred_at").alias("metrics_date"), F.col("login").alias("name"), F.col("id").alias("n"),
                         F.lit(None).cast("int").alias("uniques"))
        )
    )


def read_archive_stats(spark: SparkSession, d: str) -> DataFrame:
    """Records under ``hits.hits`` of daily documents, each in the two days whose windows hold it; older exports are skipped."""
    scratch = Scratch(spark)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size") % 20).cast("string")
    parts = read(spark, d, "part").withColumn("day", day)
    stats = F.struct(F.col("p_size").alias("downloads"))
    record = F.struct(F.col("p_partkey").cast("int").alias("id"), F.col("p_name").alias("title"), stats.alias("stats"), F.lit("x").alias("unknown"))
    docs = _array(parts, record).select("day", F.concat(F.lit('{"hits": {"hits": '), F.col("value"), F.lit("}}")).alias("value"))
    _place(spark, docs, f"{scratch.path}/archive", "{day}-1.json")
    _place(spark, docs.where(F.col("day") == DAYS[0]), f"{scratch.path}/old", "{day}-export.json")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(scratch.path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.rename(path(f"{scratch.path}/old/{DAYS[0]}-export.json"), path(f"{scratch.path}/archive/{DAYS[0]}-export.json"))
    rows = files.archive_stats(spark, f"{scratch.path}/archive", DAYS, window_days=2)
    return scratch.finish(rows.select(
        F.col("id"), F.col("title"), F.col("`stats.downloads`").alias("downloads"), F.to_date("metrics_date").alias("metrics_date"), "partition_key"
    ))


def read_client_log(spark: SparkSession, d: str) -> DataFrame:
    """CSV files with a header; files that are no usage reports are left out, as are those outside the time range."""
    scratch = Scratch(spark)
    header = ",".join(c.split()[0] for c in files.CLIENT_LOG.replace("\n", " ").split(","))
    n = F.col("event_id").cast("string")
    none = F.lit("")
    fields = [
        F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), F.lit("10.0.0.1"), F.lit("1"), none, F.lit("GET"),
        F.concat(F.lit('"/a,'), n, F.lit('"')), F.lit("200"), none, n, none, none, none, F.lit("Python"), n, F.lit("get"), none, F.lit("key"),
    ]
    rows = _events(spark, d).select("day", F.concat_ws(",", *fields).alias("line"))
    text = rows.groupBy("day").agg(F.concat(F.lit(header + "\n"), F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("value"))
    _place(spark, text, f"{scratch.path}/logs", "{day}_usage.csv")
    _place(spark, text, f"{scratch.path}/more", "{day}_storage.csv")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(scratch.path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in file_names(spark, f"{scratch.path}/more"):
        system.rename(path(f"{scratch.path}/more/{name}"), path(f"{scratch.path}/logs/{name}"))
    for name in file_names(spark, f"{scratch.path}/logs"):
        written = 1_704_067_200_000 + 86_400_000 * (int(name[8:10]) - 1)  # midnight of the day
        system.setTimes(path(f"{scratch.path}/logs/{name}"), written, -1)
    rows = files.client_log(spark, f"{scratch.path}/logs", DAYS[0], DAYS[2])
    return scratch.finish(rows.select("time_micros", "cs_uri", "sc_status", "sc_bytes", "s_request_id", "c_ip_region"))


QUERIES = {f.__name__: f for f in (read_object_log, read_viewer_log, read_documents, read_archive_stats, read_client_log)}

_IN = "strftime(ts, '%Y-%m-%d') in ('2024-01-05', '2024-01-06', '2024-01-07')"

ORACLE = {
    "read_object_log": f"""select 'R' || event_id as request_id, 'stable/' || event_type as key, 'GET /' || event_id || ' HTTP/1.1' as request_uri,
  'Agent "quoted" ' || event_id as user_agent, cast(event_id as varchar) as total_time, 'f8' as acl_required,
  case when event_id % 2 = 1 then 'us-west-2' end as aws_region, date_trunc('second', ts) as time, strftime(ts, '%Y-%m-%d') as partition_key
from events where {_IN} and event_type is not null""",
    "read_viewer_log": f"""select case when event_id % 100 > 0 then cast(event_id as varchar) end as insert_id,
  case when event_id % 100 > 0 then 't' end as text_payload, case when event_id % 100 > 0 then event_type end as event,
  case when event_id % 100 > 0 then value end as score, case when event_id % 100 > 0 then cast(2 as int) end as page,
  case when event_id % 100 = 0 then substr('{{"insertId":"' || event_id, 1, 12) end as unreadable, strftime(ts, '%Y-%m-%d') as partition_key
from events where {_IN}""",
    "read_documents": f"""select strftime(ts, '%Y-%m-%d') as metrics_date, event_type as name, cast(count(*) as integer) as n,
  cast(max(user_id) as integer) as uniques from events where {_IN} group by 1, 2
union all select '2024-05-01T10:00:00Z', c_name, cast(c_custkey as integer), null from customer""",
    "read_archive_stats": """select cast(p_partkey as integer) as id, p_name as title, p_size as downloads,
  date '2024-01-01' + p_size % 20 as metrics_date, strftime(date '2024-01-01' + p_size % 20 - back, '%Y-%m-%d') as partition_key
from part, (values (0), (1)) b(back)
where strftime(date '2024-01-01' + p_size % 20 - back, '%Y-%m-%d') in ('2024-01-05', '2024-01-06', '2024-01-07')""",
    "read_client_log": """select epoch_us(ts) as time_micros, '/a,' || event_id as cs_uri, cast(200 as integer) as sc_status,
  event_id as sc_bytes, cast(event_id as varchar) as s_request_id, null::varchar as c_ip_region
from events where strftime(ts, '%Y-%m-%d') in ('2024-01-05', '2024-01-06')""",
}
