"""Web-viewer event log: validation, sessions, six event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import nested, text, times
from trafficlake.operators import columns as C
from trafficlake.operators import quality
from trafficlake.operators.sessions import with_sessions
from trafficlake.schemas import FILTER_SLOTS, PARTITION_KEY, filter_column

# What a valid record may hold.
EVENTS = ("search", "hit", "duckdb_preview", "duckdb_csv", "privacy-policy")
FILTER_TYPES = ("text", "number", "date")
FILTER_OPERATIONS = (
    "equals",
    "contains",
    "greaterThan",
    "greaterThanOrEqual",
    "lessThan",
    "lessThanOrEqual",
    "notBlank",
    "startsWith",
    "notEqual",
    "notContains",
    "inRange",
    "blank",
    "false",
    "true",
)
# stored name of a filter's field -> its name in the record
FILTER_FIELD_NAMES = {"field_name": "fieldName", "field_type": "fieldType", "operation": "operation", "value": "value"}
FILTER = "struct<fieldName: string, fieldType: string, operation: string, value: string>"
LOG_IN = "log_in"

# event -> table
TABLES = {
    LOG_IN: "core_viewer_log_ins",
    "search": "core_viewer_searches",
    "hit": "core_viewer_hits",
    "duckdb_preview": "core_viewer_previews",
    "duckdb_csv": "core_viewer_downloads",
    "privacy-policy": "core_viewer_user_settings_updates",
}


def payload_dropped() -> Column:
    """Payloads of unknown events, or with half-filled query parameters: the payload is
    dropped, not the row."""
    event, params = F.col("jsonPayload.event"), F.col("jsonPayload.params")
    unknown = event.isNotNull() & (event != "") & ~event.isin(*EVENTS)
    half_filled = params["name"].isNotNull() & params["page"].isNull()
    return F.coalesce(unknown, F.lit(False)) | F.coalesce(half_filled, F.lit(False))


def filter_list() -> Column:
    return nested.json_list(F.col("jsonPayload.params.filters"), FILTER)


def record_rules() -> dict[str, Column]:
    """What must hold for a record; the last four rules look at kept payloads only."""
    payload = F.col("jsonPayload")
    params = payload["params"]
    absent = payload.isNull() | payload_dropped()
    filters_fine = F.forall(
        filter_list(),
        lambda f: f["fieldName"].isNotNull()
        & F.coalesce(f["fieldType"].isin(*FILTER_TYPES), F.lit(False))
        & F.coalesce(f["operation"].isin(*FILTER_OPERATIONS), F.lit(False)),
    )
    return {
        "readable": F.col("unreadable").isNull(),
        "insert id": F.col("insertId").isNotNull(),
        "log name": F.col("logName").isNotNull(),
        "labels": F.col("labels").isNotNull(),
        "resource": F.col("resource").isNotNull(),
        "timestamp": times.iso_time(F.col("timestamp")).isNotNull(),
        "receive timestamp": times.iso_time(F.col("receiveTimestamp")).isNotNull(),
        "event": absent | payload["event"].isin(*EVENTS),
        "payload timestamp": absent | times.iso_time(payload["timestamp"]).isNotNull(),
        "params": absent
        | params.isNull()
        | (params["name"].isNotNull() & params["page"].isNotNull() & params["perPage"].isNotNull()),
        # NULL, so broken, where the text is no list
        "filters": absent | params["filters"].isNull() | filters_fine,
    }


def without_event() -> Column:
    """True for records that name no event, which ``event_rows`` leaves out."""
    event = F.when(~payload_dropped(), F.col("jsonPayload")["event"])
    return F.when(text.is_login(event, F.col("textPayload")), LOG_IN).otherwise(event).isNull()


def event_rows(records: DataFrame) -> DataFrame:
    """Accepted records as flat rows: payload fields, filter slots, log-ins marked."""
    records = records.withColumn(
        "jsonPayload", F.when(~payload_dropped(), F.col("jsonPayload"))
    ).withColumn("filter_list", filter_list())
    payload = F.col("jsonPayload")
    filters = nested.widen(F.col("filter_list"), FILTER_FIELD_NAMES, FILTER_SLOTS, filter_column)
    rows = records.select(
        F.col("insertId").alias("insert_id"),
        times.iso_time(F.col("timestamp")).alias("timestamp"),
        F.col("textPayload").alias("text_payload"),
        payload["event"].alias("event"),
        payload["userId"].alias("user_id"),
        payload["userDomain"].alias("user_domain"),
        *[payload[c].alias(c) for c in ("name", "query", "score", "tags", "url")],
        payload["params"]["name"].alias("params_name"),
        payload["params"]["page"].alias("params_page"),
        payload["params"]["perPage"].alias("params_per_page"),
        *[c.alias(name) for name, c in filters.items()],
        # every entry, also beyond the last slot
        payload["params"]["filters"].alias("params_filters"),
        *[payload[c].alias(c) for c in ("accepted", "newsletter", "outreach")],
        PARTITION_KEY,
    )
    logged_in = text.is_login(F.col("event"), F.col("text_payload"))
    rows = rows.withColumn("event", F.when(logged_in, LOG_IN).otherwise(F.col("event")))
    query = F.when(F.col("event") == LOG_IN, text.login_query(F.col("text_payload")))
    return rows.withColumn("log_in_query", query).where(F.col("event").isNotNull())


def judged(raw: DataFrame) -> DataFrame:
    """All records with the rules they break: to be staged, so that a line is parsed once."""
    return quality.judged(raw, record_rules())


def events_of(records: DataFrame) -> DataFrame:
    """Events with session ids of the judged records that keep all rules."""
    return with_sessions(event_rows(records.where(F.size(quality.VIOLATIONS) == 0)))


def quarantine_of(records: DataFrame) -> DataFrame:
    """The other judged records, whole, with the rules they break."""
    whole = F.struct(*[c for c in records.columns if c not in (PARTITION_KEY, quality.VIOLATIONS)])
    return records.where(F.size(quality.VIOLATIONS) > 0).select(
        PARTITION_KEY, F.array_join(quality.VIOLATIONS, ", ").alias("rules"), F.to_json(whole).alias("record")
    )


def build_viewer_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    """All events with session ids. ``strict`` fails the job on a record that breaks a
    rule; otherwise such records are left out here and found by ``build_quarantine``."""
    keep = quality.accepted_or_fail if strict else quality.accepted
    return with_sessions(event_rows(keep(raw, record_rules())))


def build_quarantine(raw: DataFrame) -> DataFrame:
    """Records that break rules, as JSON text with the rules."""
    return quarantine_of(judged(raw))


def build_event_tables(events: DataFrame) -> dict[str, DataFrame]:
    """The six tables of one (staged) event frame; settings without a user are dropped."""
    out = {}
    for event, name in TABLES.items():
        rows = events.where(F.col("event") == event)
        if event == "privacy-policy":
            rows = rows.where(F.col("user_id").isNotNull())
        out[name] = C.conform(rows, name)
    return out
