"""Registry of the persisted tables: column names, types and keys.

The column names and types are fixed values (they are the stored contract of the
tables), written as DDL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}

PARTITION_KEY = "partition_key"
FIRST_PARTITION = "2023-08-16"
FILTER_SLOTS = 7  # columns of their own; ``params_filters`` holds the whole list
FILTER_FIELDS = ("field_name", "field_type", "operation", "value")


@dataclass(frozen=True)
class Table:
    """One registered table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def partitioned(self) -> bool:
        return PARTITION_KEY in self.schema.names


class UnknownTableError(KeyError):
    """A table that is not in the registry was asked for."""


def struct_of(ddl: str, key: tuple[str, ...] = ()) -> T.StructType:
    """Schema from DDL, its key columns marked. Needs no session."""
    fields = []
    for column in ddl.split(","):
        name, kind = column.split()
        meta = {"key": True} if name in key else {}
        fields.append(T.StructField(name, _TYPES[kind.upper()], True, meta))
    return T.StructType(fields)


def filter_column(field: str, slot: int) -> str:
    """Stored name of one field of one query filter; slot 0 carries no number."""
    return f"params_filters_{field}" + (f"_{slot}" if slot else "")


# The stored contract of each table, (key, columns in stored order).
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "core_s3_logs": (
        ("id",),
        """id STRING, time TIMESTAMP, request_uri STRING, operation STRING, bucket STRING, bucket_owner STRING,
            requester STRING, http_status INT, megabytes_sent DOUBLE, normalized_file_downloads DOUBLE,
            remote_ip STRING, remote_ip_city STRING, remote_ip_loc STRING, remote_ip_org STRING,
            remote_ip_hostname STRING, remote_ip_country_name STRING, remote_ip_asn STRING,
            remote_ip_bogon BOOLEAN, remote_ip_country STRING, remote_ip_timezone STRING,
            remote_ip_latitude DOUBLE, remote_ip_longitude DOUBLE, remote_ip_postal STRING,
            remote_ip_region STRING, remote_ip_full_location STRING, access_point_arn STRING, acl_required STRING,
            authentication_type STRING, cipher_suite STRING, error_code STRING, host_header STRING, host_id STRING,
            key STRING, object_size DOUBLE, request_id STRING, referer STRING, signature_version STRING,
            tls_version STRING, total_time BIGINT, turn_around_time DOUBLE, user_agent STRING, version_id STRING,
            partition_key STRING""",
    ),
    "out_s3_logs": (
        ("id",),
        """id STRING, time TIMESTAMP, table STRING, version STRING, usage_type STRING, remote_ip STRING,
            remote_ip_city STRING, remote_ip_loc STRING, remote_ip_org STRING, remote_ip_hostname STRING,
            remote_ip_country_name STRING, remote_ip_asn STRING, remote_ip_bogon BOOLEAN, remote_ip_country STRING,
            remote_ip_timezone STRING, remote_ip_latitude DOUBLE, remote_ip_longitude DOUBLE,
            remote_ip_postal STRING, remote_ip_region STRING, remote_ip_full_location STRING,
            access_point_arn STRING, acl_required STRING, authentication_type STRING, megabytes_sent DOUBLE,
            normalized_file_downloads DOUBLE, cipher_suite STRING, error_code STRING, host_header STRING,
            host_id STRING, http_status INT, key STRING, object_size DOUBLE, referer STRING, request_id STRING,
            request_uri STRING, signature_version STRING, tls_version STRING, total_time BIGINT,
            turn_around_time DOUBLE, user_agent STRING, version_id STRING, partition_key STRING""",
    ),
    "out_s3_daily_summary_by_table": (
        ("id",),
        """id STRING, time TIMESTAMP, table STRING, version STRING, usage_type STRING, megabytes_sent DOUBLE,
            normalized_file_downloads DOUBLE, request_count INT, partition_key STRING""",
    ),
    "out_s3_daily_summary_by_user": (
        ("id",),
        """id STRING, time TIMESTAMP, table STRING, version STRING, usage_type STRING, remote_ip STRING,
            remote_ip_org STRING, remote_ip_country_name STRING, megabytes_sent DOUBLE,
            normalized_file_downloads DOUBLE, request_count INT, partition_key STRING""",
    ),
    "out_s3_daily_summary_by_db": (
        ("id",),
        """id STRING, time TIMESTAMP, database STRING, version STRING, usage_type STRING, megabytes_sent DOUBLE,
            normalized_file_downloads DOUBLE, request_count INT, partition_key STRING""",
    ),
    "core_kaggle_logs": (
        ("metrics_date",),
        """metrics_date TIMESTAMP, total_views INT, total_downloads INT, total_votes INT, usability_rating DOUBLE,
            dataset_name STRING, owner STRING, title STRING, subtitle STRING, description STRING, keywords STRING,
            dataset_id STRING, is_private STRING, licenses STRING, collaborators STRING, data STRING,
            partition_key STRING""",
    ),
    "core_github_popular_referrers": (
        ("metrics_date", "referrer",),
        """metrics_date DATE, referrer STRING, total_referrals INT, unique_referrals INT, partition_key STRING""",
    ),
    "core_github_popular_paths": (
        ("metrics_date", "path",),
        """metrics_date DATE, path STRING, title STRING, total_views INT, unique_views INT, partition_key STRING""",
    ),
    "core_github_clones": (
        ("metrics_date",),
        """metrics_date DATE, total_clones INT, unique_clones INT, partition_key STRING""",
    ),
    "core_github_views": (
        ("metrics_date",),
        """metrics_date DATE, total_views INT, unique_views INT, partition_key STRING""",
    ),
    "core_github_forks": (
        ("id",),
        """id INT, node_id STRING, name STRING, full_name STRING, private BOOLEAN, owner STRING,
            description STRING, url STRING, created_at TIMESTAMP, updated_at TIMESTAMP, pushed_at TIMESTAMP,
            homepage STRING, size_kb INT, stargazers_count INT, watchers_count INT, language STRING,
            has_issues BOOLEAN, has_projects BOOLEAN, has_downloads BOOLEAN, has_wiki BOOLEAN, has_pages BOOLEAN,
            has_discussions BOOLEAN, has_pull_requests BOOLEAN, forks_count INT, archived BOOLEAN,
            disabled BOOLEAN, license STRING, allow_forking BOOLEAN, is_template BOOLEAN,
            web_commit_signoff_required BOOLEAN, topics STRING, visibility STRING, forks INT, open_issues INT,
            watchers INT, default_branch STRING, permissions STRING""",
    ),
    "core_github_stargazers": (
        ("id",),
        """id INT, starred_at TIMESTAMP, login STRING, node_id STRING, url STRING, html_url STRING,
            followers_url STRING, following_url STRING, gists_url STRING, starred_url STRING,
            subscriptions_url STRING, organizations_url STRING, repos_url STRING, events_url STRING,
            received_events_url STRING, type STRING, site_admin BOOLEAN""",
    ),
    "core_zenodo_logs": (
        ("metrics_date", "version_id",),
        """metrics_date DATE, version STRING, dataset_slug STRING, dataset_downloads INT,
            dataset_unique_downloads INT, dataset_views INT, dataset_unique_views INT, version_downloads INT,
            version_unique_downloads INT, version_views INT, version_unique_views INT, version_title STRING,
            version_id INT, version_record_id INT, concept_record_id INT, version_creation_date TIMESTAMP,
            version_last_modified_date TIMESTAMP, version_last_updated_date TIMESTAMP,
            version_publication_date DATE, version_doi STRING, concept_record_doi STRING, version_doi_url STRING,
            version_status STRING, version_state STRING, version_submitted BOOLEAN, version_description STRING,
            partition_key STRING, software_hash_id STRING""",
    ),
    "core_viewer_log_ins": (
        ("insert_id",),
        """insert_id STRING, timestamp TIMESTAMP, text_payload STRING, log_in_query STRING, partition_key STRING""",
    ),
    "core_viewer_searches": (
        ("insert_id",),
        """insert_id STRING, user_id STRING, user_domain STRING, timestamp TIMESTAMP, query STRING, url STRING,
            session_id STRING, partition_key STRING""",
    ),
    "core_viewer_hits": (
        ("insert_id",),
        """insert_id STRING, timestamp TIMESTAMP, name STRING, score DOUBLE, tags STRING, partition_key STRING""",
    ),
    "core_viewer_previews": (
        ("insert_id",),
        """insert_id STRING, user_id STRING, user_domain STRING, timestamp TIMESTAMP, url STRING,
            params_name STRING, params_page INT, params_per_page INT, params_filters_field_name STRING,
            params_filters_field_type STRING, params_filters_operation STRING, params_filters_value STRING,
            params_filters_field_name_1 STRING, params_filters_field_type_1 STRING,
            params_filters_operation_1 STRING, params_filters_value_1 STRING, params_filters_field_name_2 STRING,
            params_filters_field_type_2 STRING, params_filters_operation_2 STRING, params_filters_value_2 STRING,
            params_filters_field_name_3 STRING, params_filters_field_type_3 STRING,
            params_filters_operation_3 STRING, params_filters_value_3 STRING, params_filters_field_name_4 STRING,
            params_filters_field_type_4 STRING, params_filters_operation_4 STRING, params_filters_value_4 STRING,
            params_filters_field_name_5 STRING, params_filters_field_type_5 STRING,
            params_filters_operation_5 STRING, params_filters_value_5 STRING, params_filters_field_name_6 STRING,
            params_filters_field_type_6 STRING, params_filters_operation_6 STRING, params_filters_value_6 STRING,
            params_filters STRING, session_id STRING, partition_key STRING""",
    ),
    "core_viewer_downloads": (
        ("insert_id",),
        """insert_id STRING, user_id STRING, user_domain STRING, timestamp TIMESTAMP, url STRING,
            params_name STRING, params_page INT, params_per_page INT, params_filters_field_name STRING,
            params_filters_field_type STRING, params_filters_operation STRING, params_filters_value STRING,
            params_filters_field_name_1 STRING, params_filters_field_type_1 STRING,
            params_filters_operation_1 STRING, params_filters_value_1 STRING, params_filters_field_name_2 STRING,
            params_filters_field_type_2 STRING, params_filters_operation_2 STRING, params_filters_value_2 STRING,
            params_filters_field_name_3 STRING, params_filters_field_type_3 STRING,
            params_filters_operation_3 STRING, params_filters_value_3 STRING, params_filters_field_name_4 STRING,
            params_filters_field_type_4 STRING, params_filters_operation_4 STRING, params_filters_value_4 STRING,
            params_filters_field_name_5 STRING, params_filters_field_type_5 STRING,
            params_filters_operation_5 STRING, params_filters_value_5 STRING, params_filters_field_name_6 STRING,
            params_filters_field_type_6 STRING, params_filters_operation_6 STRING, params_filters_value_6 STRING,
            params_filters STRING, session_id STRING, partition_key STRING""",
    ),
    "core_viewer_user_settings_updates": (
        ("insert_id",),
        """insert_id STRING, user_id STRING, user_domain STRING, timestamp TIMESTAMP, accepted BOOLEAN,
            newsletter BOOLEAN, outreach BOOLEAN, partition_key STRING""",
    ),
    "core_viewer_quarantine": (
        ("record",),
        """rules STRING, record STRING, partition_key STRING""",
    ),
    "datasette_request_logs": (
        ("insert_id",),
        """insert_id STRING, log_name STRING, resource STRING, text_payload STRING, timestamp TIMESTAMP,
            receive_timestamp TIMESTAMP, severity STRING, http_request STRING, labels STRING, operation STRING,
            trace STRING, span_id STRING, trace_sampled BOOLEAN, source_location STRING, cache_hit STRING,
            cache_lookup STRING, request_url STRING, protocol STRING, cache_fill_bytes STRING,
            response_size DOUBLE, server_ip STRING, cache_validated_with_origin_server STRING,
            request_method STRING, request_size INT, user_agent STRING, status INT, referer STRING, latency DOUBLE,
            remote_ip STRING, request_url_path STRING, request_url_query STRING, request_url_scheme STRING,
            request_url_netloc STRING, remote_ip_city STRING, remote_ip_loc STRING, remote_ip_org STRING,
            remote_ip_hostname STRING, remote_ip_country_name STRING, remote_ip_asn STRING,
            remote_ip_country STRING, remote_ip_timezone STRING, remote_ip_latitude DOUBLE,
            remote_ip_longitude DOUBLE, remote_ip_postal STRING, remote_ip_region STRING,
            remote_ip_full_location STRING, partition_key STRING""",
    ),
    "intake_logs": (
        ("insert_id",),
        """insert_id STRING, timestamp TIMESTAMP, remote_ip STRING, request_method STRING, request_uri STRING,
            response_status INT, request_bytes BIGINT, response_bytes BIGINT, response_time_taken BIGINT,
            request_host STRING, request_referer STRING, request_user_agent STRING, request_operation STRING,
            request_bucket STRING, request_object STRING, tag STRING, object_path STRING, remote_ip_type STRING,
            remote_ip_city STRING, remote_ip_loc STRING, remote_ip_org STRING, remote_ip_hostname STRING,
            remote_ip_country_name STRING, remote_ip_asn STRING, remote_ip_country STRING,
            remote_ip_timezone STRING, remote_ip_latitude DOUBLE, remote_ip_longitude DOUBLE,
            remote_ip_postal STRING, remote_ip_region STRING, remote_ip_full_location STRING, partition_key STRING""",
    ),
}


def _build() -> dict[str, Table]:
    tables = {}
    for name, (key, ddl) in _TABLES.items():
        tables[name] = Table(name, struct_of(ddl, key), key)
    return tables


REGISTRY: dict[str, Table] = _build()


def table(name: str) -> Table:
    """The registered table ``name``; an unregistered one is an error."""
    try:
        return REGISTRY[name]
    except KeyError:
        raise UnknownTableError(
            f"{name} has no registered schema; add it to trafficlake.schemas"
        ) from None
