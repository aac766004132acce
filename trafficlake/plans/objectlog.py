"""Object-store access logs: typed log, usage log, daily summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import numbers, text, times
from trafficlake.operators import columns as C
from trafficlake.operators.dedup import distinct_by_key
from trafficlake.operators.enrich import with_ip_details
from trafficlake.schemas import PARTITION_KEY
from trafficlake.site import Site

# Operations of the log and the two file endings treated as one format.
LIFECYCLE_OPERATION = "S3.TRANSITION_INT.OBJECT"
GET_OPERATIONS = ("REST.GET.BUCKET", "REST.GET.OBJECT")
SAME_FORMAT = (("sqlite.gz", "sqlite"), ("sqlite.zip", "sqlite"))
SAME_FORMAT_TEXT = "sqlite"
NOT_IN_USAGE_LOG = ("bucket_owner", "requester", "operation", "bucket")
NUMERIC_FIELDS = {
    "bytes_sent": "double",
    "http_status": "int",
    "object_size": "double",
    "total_time": "bigint",
    "turn_around_time": "double",
}


def typed_rows(raw: DataFrame) -> DataFrame:
    """Raw fields as typed columns with measures and an id, life-cycle rows left out.

    A time that cannot be read fails the job; ``times.unreadable`` finds such rows beforehand.
    """
    typed = raw.where(~F.col("operation").eqNullSafe(LIFECYCLE_OPERATION)).withColumns(
        {
            "time": times.readable(
                times.access_log_text(F.col("time"), F.col("timezone")),
                times.access_log_time(F.col("time"), F.col("timezone")),
            ),
            "remote_ip": text.dash_to_null(F.col("remote_ip")),
            "bytes_sent": numbers.dash_to_zero(F.col("bytes_sent")),
        }
    )
    typed = typed.withColumns(
        {c: numbers.number_or_null(F.col(c), kind) for c, kind in NUMERIC_FIELDS.items()}
    )
    return C.drop(typed, ["timezone", "aws_region"])


def measured(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "normalized_file_downloads": numbers.share(F.col("bytes_sent"), F.col("object_size")),
            "megabytes_sent": numbers.megabytes(F.col("bytes_sent")),
            "id": text.joined_id(F.col("request_id"), F.col("operation"), F.col("key")),
        }
    )


def build_core_s3_logs(raw: DataFrame, ip_records: DataFrame, **join_options) -> DataFrame:
    """Typed access log with address details; repeated rows once, ids unique per partition.

    De-duplication comes before the address lookup: the looked-up columns depend on the
    address alone, so the result is the same and far less data is shuffled.
    """
    rows = distinct_by_key(measured(typed_rows(raw)), [PARTITION_KEY, "id"])
    return C.conform(with_ip_details(rows, ip_records, **join_options), "core_s3_logs")


def usage_rows(core: DataFrame, site: Site) -> DataFrame:
    """GET requests of outside users that sent data, with version, table and usage type."""
    asked = core.where(
        F.col("operation").isin(*GET_OPERATIONS) & (F.col("megabytes_sent") > 0)
    )
    if site.internal_requesters:
        inside = F.col("requester").isin(*site.internal_requesters)
        asked = asked.where(~F.coalesce(inside, F.lit(False)))
    split = asked.withColumns(
        {"version": text.version_of(F.col("key")), "table": text.table_of(F.col("key"))}
    )
    kept = split.where(
        ~text.any_affix(F.col("table"), site.dropped_prefixes, site.dropped_suffixes)
    )
    cleaned = text.replace_in_strings(kept, SAME_FORMAT, SAME_FORMAT_TEXT)
    table = F.col("table")
    for part, new_name in site.renamed_tables:
        table = F.when(F.contains(table, F.lit(part)), new_name).otherwise(table)
    labelled = cleaned.withColumns(
        {
            "table": table,
            "usage_type": text.usage_type(
                F.col("referer"), F.col("version"), F.col(PARTITION_KEY), site
            ),
        }
    )
    return C.drop(labelled, NOT_IN_USAGE_LOG)


def build_out_s3_logs(core: DataFrame, site: Site) -> DataFrame:
    return C.conform(usage_rows(core, site), "out_s3_logs")


def build_daily_summaries(at_once: DataFrame) -> dict[str, DataFrame]:
    """The three summary tables of (staged) ``summaries.summaries_at_once``."""
    return {
        f"out_s3_daily_summary_{kind}": C.conform(
            at_once.where(F.col("summary") == kind), f"out_s3_daily_summary_{kind}"
        )
        for kind in ("by_table", "by_user", "by_db")
    }
