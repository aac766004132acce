"""File sources. Every reader takes a root folder (any Hadoop URI) and, optionally, the
days wanted; file names decide which day a record belongs to, not its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.functions import nested, times
from trafficlake.operators.columns import q
from trafficlake.schemas import PARTITION_KEY
from trafficlake.sinks.append import path_exists

# Fields of an object-store access log, in file order. The last one was
# added in February 2026; older lines are shorter and get NULL.
OBJECT_LOG_FIELDS = (
    "bucket_owner",
    "bucket",
    "time",
    "timezone",
    "remote_ip",
    "requester",
    "request_id",
    "operation",
    "key",
    "request_uri",
    "http_status",
    "error_code",
    "bytes_sent",
    "object_size",
    "total_time",
    "turn_around_time",
    "referer",
    "user_agent",
    "version_id",
    "host_id",
    "signature_version",
    "cipher_suite",
    "authentication_type",
    "host_header",
    "tls_version",
    "access_point_arn",
    "acl_required",
    "aws_region",
)
_SURPLUS = "__surplus"

# Record layouts of the JSON sources.
VIEWER_LOG = """insertId string, logName string, receiveTimestamp string, timestamp string,
 textPayload string, labels map<string,string>,
 resource struct<type: string, labels: map<string,string>>,
 jsonPayload struct<event: string, timestamp: string, userId: string, userDomain: string,
  name: string, query: string, score: double, tags: string, url: string,
  params: struct<filters: string, name: string, page: int, perPage: int>,
  accepted: boolean, newsletter: boolean, outreach: boolean>,
 unreadable string"""
TRAFFIC_ENTRY = "struct<timestamp: string, count: int, uniques: int>"
POPULAR_PATHS = "path string, title string, count int, uniques int"
POPULAR_REFERRERS = "referrer string, count int, uniques int"
STARGAZERS = """starred_at string, user struct<id: int, login: string, node_id: string,
 avatar_url: string, gravatar_id: string, url: string, html_url: string, followers_url: string,
 following_url: string, gists_url: string, starred_url: string, subscriptions_url: string,
 organizations_url: string, repos_url: string, events_url: string, received_events_url: string,
 type: string, user_view_type: string, site_admin: boolean>"""
FORKS = """id int, node_id string, name string, full_name string, private boolean, owner string,
 description string, fork boolean, url string, html_url string, clone_url string,
 created_at string, updated_at string, pushed_at string, homepage string, size int,
 stargazers_count int, watchers_count int, language string, has_issues boolean,
 has_projects boolean, has_downloads boolean, has_wiki boolean, has_pages boolean,
 has_discussions boolean, has_pull_requests boolean, forks_count int, archived boolean,
 disabled boolean, open_issues_count int, license string, allow_forking boolean,
 is_template boolean, web_commit_signoff_required boolean, topics string, visibility string,
 forks int, open_issues int, watchers int, default_branch string, permissions string,
 pull_request_creation_policy string"""
ARCHIVE_STATS = """hits struct<hits: array<struct<created: string, modified: string,
 updated: string, id: int, recid: string, conceptrecid: string, doi: string, conceptdoi: string,
 doi_url: string, title: string, status: string, state: string, submitted: boolean,
 metadata: struct<publication_date: string, description: string, version: string>,
 stats: struct<downloads: int, unique_downloads: int, views: int, unique_views: int,
  version_downloads: int, version_unique_downloads: int, version_views: int,
  version_unique_views: int>,
 swh: string>>>"""
CLIENT_LOG = """time_micros bigint, c_ip string, c_ip_type int, c_ip_region string,
 cs_method string, cs_uri string, sc_status int, cs_bytes bigint, sc_bytes bigint,
 time_taken_micros bigint, cs_host string, cs_referer string, cs_user_agent string,
 s_request_id string, cs_operation string, cs_bucket string, cs_object string"""
SNAPSHOT_FIELDS = (
    "datasetSlug",
    "ownerUser",
    "usabilityRating",
    "title",
    "subtitle",
    "description",
    "datasetId",
    "totalViews",
    "totalVotes",
    "totalDownloads",
    "isPrivate",
    "keywords",
    "licenses",
    "collaborators",
    "data",
)

FILE_NAME = "_metadata.file_name"
FILE_PATH = "_metadata.file_path"
FILE_TIME = "_metadata.file_modification_time"


def _no_rows(spark: SparkSession, schema: T.StructType | str, *more: str) -> DataFrame:
    df = spark.createDataFrame([], schema)
    return df.withColumns({name: F.lit(None).cast("string") for name in more})


def _days_glob(days: Sequence[str] | None, suffix: str) -> str:
    """File-name glob for some days, or for any name."""
    if days is None:
        return f"*{suffix}"
    return "{" + ",".join(days) + "}" + suffix


def _file_day() -> Column:
    return times.date_in_text(F.col(FILE_NAME))


def _object_log_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*OBJECT_LOG_FIELDS, _SURPLUS)])


def _wanted(spark: SparkSession, root: str, days: Sequence[str] | None, suffix: str) -> str | None:
    """Path of the files of the wanted days, the days in the glob itself; None if there are none."""
    path = f"{root}/{_days_glob(days, suffix)}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return path if found is not None and len(found) else None


def _object_log_lines(reader, path: str) -> DataFrame:
    """Lines through a batch or a streaming reader; a line with unknown fields fails the job."""
    lines = (
        reader.schema(_object_log_schema())
        .option("sep", " ")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
        .withColumn(PARTITION_KEY, _file_day())
    )
    message = F.concat(F.lit("access-log line with unknown fields: "), F.col(_SURPLUS))
    known_width = F.when(F.col(_SURPLUS).isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return lines.where(known_width).drop(_SURPLUS)


def object_log(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """Access-log lines of files whose name starts with a wanted day.

    Space-delimited, quoted, without header. Shorter lines get NULLs; a line with more
    fields than known fails the job instead of being shifted or cut.
    """
    path = _wanted(spark, root, days, "*")
    if path is None:
        return _no_rows(spark, _object_log_schema(), PARTITION_KEY).drop(_SURPLUS)
    return _object_log_lines(spark.read, path)


def object_log_stream(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """The same lines as a stream of newly arrived files."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _object_log_lines(reader, root)


def viewer_log(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """JSON lines below ``<root>/YYYY/MM/DD``; broken lines are kept in ``unreadable``."""
    paths = [root]
    if days is not None:
        paths = [f"{root}/{day.replace('-', '/')}" for day in days]
    paths = [p for p in paths if path_exists(spark, p)]
    schema = T.StructType.fromDDL(VIEWER_LOG)
    if not paths:
        return _no_rows(spark, schema, PARTITION_KEY)
    lines = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("columnNameOfCorruptRecord", "unreadable")
        .json(paths)
    )
    day = F.regexp_extract(FILE_PATH, r"/(\d{4}/\d{2}/\d{2})", 1)
    return lines.withColumn(PARTITION_KEY, F.replace(day, F.lit("/"), F.lit("-")))


def _documents(
    spark: SparkSession, root: str, schema: str | T.StructType, days: Sequence[str] | None, suffix: str = ".json"
) -> DataFrame:
    """Whole-file JSON documents of the wanted days, with the day of their file name."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    path = _wanted(spark, root, days, suffix)
    if path is None:
        return _no_rows(spark, schema, PARTITION_KEY)
    return (
        spark.read.schema(schema)
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .json(path)
        .withColumn(PARTITION_KEY, _file_day())
    )


def traffic_series(
    spark: SparkSession, root: str, metric: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Entries of the array under key ``metric`` (clones or views), one row each."""
    docs = _documents(
        spark, root, f"{metric} array<{TRAFFIC_ENTRY}>", days
    )
    return nested.explode_array(docs, metric, PARTITION_KEY)


def popular(
    spark: SparkSession, root: str, metric: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Rows of top-level arrays (popular paths or referrers) with the day of the file."""
    schema = {"popular_paths": POPULAR_PATHS, "popular_referrers": POPULAR_REFERRERS}[metric]
    docs = _documents(spark, root, schema, days)
    return docs.withColumn("metrics_date", F.col(PARTITION_KEY))


def newest_file(spark: SparkSession, root: str) -> str | None:
    """Path of the newest file in a folder; only the listing is read."""
    if not path_exists(spark, root):
        return None
    files = spark.read.format("binaryFile").load(root)
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def newest_document(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of the newest full-history document of a folder (a top-level array)."""
    path = newest_file(spark, root)
    if path is None:
        return _no_rows(spark, T.StructType.fromDDL(schema))
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def stargazers(spark: SparkSession, root: str) -> DataFrame:
    return nested.lift(newest_document(spark, root, STARGAZERS), "user", "starred_at")


def forks(spark: SparkSession, root: str) -> DataFrame:
    """Nested values arrive as JSON text: the reader keeps them when the type is string."""
    return newest_document(spark, root, FORKS)


def snapshot_schema() -> T.StructType:
    """All layouts of a snapshot at once: fields at the top level, with an ``info.`` name
    prefix, or inside an ``info`` object, each with ``xNullable``/``hasX`` twins."""
    text, flag = T.StringType(), T.BooleanType()
    flat = [
        field
        for name in SNAPSHOT_FIELDS
        for field in (
            T.StructField(name, text),
            T.StructField(f"{name}Nullable", text),
            T.StructField(f"has{name[0].upper()}{name[1:]}", flag),
        )
    ]
    dotted = [T.StructField(f"info.{f.name}", f.dataType) for f in flat]
    return T.StructType(
        [
            T.StructField("metrics_date", text),
            T.StructField("hasErrorMessage", flag),
            T.StructField("errorMessage", text),
            T.StructField("info", T.StructType(flat)),
            *flat,
            *dotted,
        ]
    )


def dataset_snapshots(
    spark: SparkSession, root: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Snapshots in any of the three layouts the archive has used."""
    return _documents(spark, root, snapshot_schema(), days)


def archive_stats(
    spark: SparkSession, root: str, days: Sequence[str] | None = None, window_days: int = 7
) -> DataFrame:
    """Records of archived statistics, flattened, with the day of the file.

    A partition ``D`` reads the files of ``D`` to ``D + window_days - 1``, so a file is
    part of several partitions; ``window_days=1`` gives each file to its own day only.
    Files not named ``YYYY-MM-DD-<number>.json`` (older exports) are skipped.
    """
    wanted = None
    if days is not None:
        wanted = sorted({d for day in days for d in times.window_days(day, window_days)})
    docs = _documents(spark, root, ARCHIVE_STATS, wanted, "-*.json")
    if _wanted(spark, root, wanted, "-*.json") is not None:
        docs = docs.where(F.rlike(FILE_NAME, F.lit(r"^\d{4}-\d{2}-\d{2}-\d+\.json$")))
    keyed = archive_records(docs, window_days)
    return keyed if days is None else keyed.where(F.col(PARTITION_KEY).isin(*days))


def archive_records(docs: DataFrame, window_days: int) -> DataFrame:
    """Flattened records of documents, once per partition whose window holds their day."""
    records = nested.explode_array(
        docs.select(F.col(PARTITION_KEY).alias("metrics_date"), F.col("hits.hits").alias("records")),
        "records",
        "metrics_date",
    )
    back = F.explode(F.sequence(F.lit(0), F.lit(window_days - 1)))
    day = F.date_sub(F.to_date("metrics_date"), F.col("__back"))
    return (
        nested.flatten(records, ".")
        .withColumn("__back", back)
        .withColumn(PARTITION_KEY, F.date_format(day, "yyyy-MM-dd"))
        .drop("__back")
    )


def client_log(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Storage usage CSVs written from ``start`` (included) to ``end`` (excluded)."""
    schema = T.StructType.fromDDL(CLIENT_LOG)
    if not path_exists(spark, root):
        return _no_rows(spark, schema)
    rows = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("pathGlobFilter", "*usage*")
        .csv(root)
    )
    if start is not None:
        rows = rows.where(F.col(FILE_TIME) >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.where(F.col(FILE_TIME) < F.lit(end).cast("timestamp"))
    return rows.select(*[q(c) for c in schema.names])
