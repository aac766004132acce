"""Request logs of the two older services: API requests and client downloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import nested, text, times
from trafficlake.operators import columns as C
from trafficlake.operators.dedup import keep_first
from trafficlake.operators.enrich import with_ip_details
from trafficlake.operators.quality import unique_or_fail
from trafficlake.schemas import PARTITION_KEY
from trafficlake.site import Site

# Columns of the API request log that never hold data, nested columns, and
# the request record the service writes.
EMPTY_COLUMNS = (
    "cache_lookup",
    "cache_hit",
    "cache_validated_with_origin_server",
    "cache_fill_bytes",
    "operation",
    "span_id",
    "trace_sampled",
    "source_location",
)
HTTP_REQUEST = (
    "requestMethod string, requestUrl string, requestSize string, status int, "
    "responseSize string, userAgent string, remoteIp string, serverIp string, "
    "referer string, latency string, protocol string, cacheLookup string, cacheHit string, "
    "cacheValidatedWithOriginServer string, cacheFillBytes string"
)
# How the fields of the storage usage log are renamed.
CLIENT_LOG_NAMES = {
    "c_ip": "remote_ip",
    "c_ip_type": "remote_ip_type",
    "c_ip_region": "remote_ip_region",
    "time_taken_micros": "response_time_taken",
    "time_micros": "timestamp",
    "s_request_id": "insert_id",
}
CLIENT_LOG_PREFIXES = {"cs": "request", "sc": "response"}
CLIENT_OPERATION = "storage.objects.get"
CLIENT_AGENT = "python"


def parsed_requests(raw: DataFrame) -> DataFrame:
    """One row per insert id, request record and URL parts as columns."""
    rows = keep_first(
        C.to_snake_case(raw),
        ["insert_id"],
        [F.col("timestamp").asc_nulls_last(), F.xxhash64(F.col("http_request"))],
    )
    rows = nested.unpack_json(rows, "http_request", HTTP_REQUEST, "__r_")
    rows = C.rename_by(
        rows, lambda c: text.snake_case(c.removeprefix("__r_")) if c.startswith("__r_") else c
    )
    parts = text.url_parts(F.col("request_url"))
    rows = rows.withColumns({f"request_url_{name}": part for name, part in parts.items()})
    return C.drop(rows, EMPTY_COLUMNS)


def build_datasette_request_logs(
    raw: DataFrame, ip_records: DataFrame, site: Site, partition: Column | str | None = None, **join
) -> DataFrame:
    """Requests for data paths with address details.

    Nested columns of ``raw`` may come as structs or as JSON text. The path filter runs
    before the address lookup, which neither adds nor drops rows.
    """
    rows = parsed_requests(nested.nested_to_text(raw))
    data = rows.where(text.any_pattern(F.col("request_url_path"), site.data_paths))
    joined = with_ip_details(data, ip_records, **join)
    return C.conform(joined, "datasette_request_logs", partition)


def renamed_client_log(raw: DataFrame) -> DataFrame:
    return C.rename_prefixes(raw, CLIENT_LOG_PREFIXES, CLIENT_LOG_NAMES)


def build_intake_logs(
    raw: DataFrame, ip_records: DataFrame, partition: Column | str | None = None, **join
) -> DataFrame:
    """Object downloads made by the Python client, with tag, object path and address details."""
    rows = unique_or_fail(renamed_client_log(raw), ["insert_id"], "client log: key repeats")
    asked = rows.where(
        F.contains(F.lower("request_user_agent"), F.lit(CLIENT_AGENT))
        & (F.col("request_operation") == CLIENT_OPERATION)
    )
    named = C.drop(asked, ["remote_ip_region", PARTITION_KEY]).withColumns(
        {
            "timestamp": times.readable(
                F.col("timestamp"), times.micros_to_time(F.col("timestamp").try_cast("bigint"))
            ),
            "object_path": text.object_path_of(F.col("request_object")),
            "tag": text.tag_of(F.col("request_object")),
        }
    )
    records = C.drop(ip_records, ["type"])
    return C.conform(with_ip_details(named, records, **join), "intake_logs", partition)
