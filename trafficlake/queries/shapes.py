"""Queries for columns, nested values and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import nested, text
from trafficlake.operators import columns as C
from trafficlake.operators.reports import null_profile
from trafficlake.plans.requests import build_datasette_request_logs
from trafficlake.plans.viewer import FILTER_FIELD_NAMES
from trafficlake.queries.bindings import SITE, read
from trafficlake.schemas import FILTER_FIELDS, FILTER_SLOTS, filter_column

# --- columns ------------------------------------------------------------------------


def rename_columns(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("csOrderKey"),
        F.col("l_linenumber").alias("scLineNumber"),
        F.col("l_quantity").alias("requestURLPath"),
        F.col("l_returnflag").alias("s_request_id"),
        F.col("l_shipdate").alias("info.shipped"),
        F.col("l_tax").alias("taxNullable"),
    )
    lines = C.strip_names(lines, prefix="info.", suffix="Nullable")
    lines = C.rename_prefixes(
        C.to_snake_case(lines), {"cs": "request", "sc": "response"}, {"s_request_id": "insert_id"}
    )
    return C.rename(lines, {"tax": "tax_rate", "absent": "nothing"})


def drop_columns(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part").select(
        "*",
        F.col("p_name").alias("home_url"),
        F.col("p_name").alias("metadata.version"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("sizeNullable"),
        F.col("p_size").alias("size"),
        (F.col("p_size") > 10).alias("hasSize"),
    )
    part = C.drop_where(part, lambda c: "_url" in c or c.startswith(("metadata.", "links.")))
    part = C.drop_twins(part)
    return C.drop(part, ["p_retailprice", "p_brand", "not_there"])


def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """Columns only one of two tables has, with how many values they hold."""
    orders = read(spark, d, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    sides = C.schema_difference(orders, lines)
    left = [c for c, side in sides if side == "left"]
    right = [c for c, side in sides if side == "right"]
    profile = null_profile(orders.select(*left)).withColumn("side", F.lit("left")).unionByName(
        null_profile(lines.select(*right)).withColumn("side", F.lit("right"))
    )
    return profile.select("column", "side", "n_values")


# --- nested values ------------------------------------------------------------------


def json_explode_array(spark: SparkSession, d: str) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(c).alias("count"))
            for name, c in (
                ("quantity", "l_quantity"), ("price", "l_extendedprice"), ("tax", "l_tax"),
            )
        ]
    )
    some = F.slice(entries, 1, F.col("l_linenumber") % 4)
    docs = read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_json(F.struct(some.alias("views"))).alias("doc")
    )
    parsed = F.from_json("doc", "views array<struct<name: string, count: double>>")
    return nested.explode_array(
        docs.withColumn("views", parsed["views"]), "views", "l_orderkey", "l_linenumber"
    )


def _accounts(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = read(spark, d, "customer"), read(spark, d, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    return joined.select(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("login"),
            F.struct(
                F.col("n_nationkey").alias("key"),
                F.col("n_name").alias("name"),
                F.struct(F.col("n_regionkey").alias("region")).alias("attrs"),
            ).alias("nation"),
            F.array(
                F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
            ).alias("infos"),
        ).alias("user"),
        F.col("c_acctbal").alias("starred_at"),
    )


def struct_lift(spark: SparkSession, d: str) -> DataFrame:
    lifted = nested.lift(_accounts(spark, d), "user", "starred_at")
    return lifted.select("id", "login", "starred_at")


def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(_accounts(spark, d)).drop("user_infos")


def nested_drop_fields(spark: SparkSession, d: str) -> DataFrame:
    pruned = nested.drop_nested(
        _accounts(spark, d), "user", "login", "nation.attrs", "nation.not_there", "gone"
    )
    lifted = nested.lift(pruned, "user", "starred_at").withColumnRenamed("infos", "info_list")
    lifted = nested.drop_in_array(lifted, "info_list", "balance", "gone")
    return nested.nested_to_text(lifted)


def json_unpack(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").withColumn(
        "props", F.when(F.col("event_type") != "error", F.col("props"))
    )
    return nested.unpack_json(events, "props", "k int, absent string", "props_").select(
        "event_id", "props_k", "props_absent"
    )


FILTER = "fieldName: string, fieldType: string, operation: string, value: string"
_LINE_FIELDS = (
    ("l_orderkey", "number", "equals"), ("l_partkey", "number", "greaterThan"),
    ("l_suppkey", "number", "lessThan"), ("l_linenumber", "number", "notEqual"),
    ("l_returnflag", "text", "contains"), ("l_linestatus", "text", "startsWith"),
    ("l_quantity", "number", "inRange"), ("l_returnflag", "text", "blank"),
)


def json_array_to_wide(spark: SparkSession, d: str) -> DataFrame:
    """Filter lists of 0 to 8 entries as JSON text: the stored slots, and the whole list beside them."""
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("fieldName"), F.lit(kind).alias("fieldType"),
                F.lit(op).alias("operation"), F.col(c).cast("string").alias("value"),
            )
            for c, kind, op in _LINE_FIELDS
        ]
    )
    size = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    lines = read(spark, d, "lineitem").withColumn(
        "filters", F.to_json(F.slice(items, 1, size.cast("int")))
    )
    parsed = lines.withColumn("list", nested.json_list(F.col("filters"), f"struct<{FILTER}>"))
    wide = nested.widen(F.col("list"), FILTER_FIELD_NAMES, FILTER_SLOTS, filter_column)
    return parsed.withColumns(wide).select(
        "l_orderkey", "l_linenumber", F.size("list").alias("filters_total"),
        F.col("filters").alias("params_filters"), *wide,
    )


def nested_to_string(spark: SparkSession, d: str) -> DataFrame:
    regions = read(spark, d, "customer").select(
        "c_custkey",
        F.struct("c_custkey", "c_name").alias("owner"),
        F.array("c_mktsegment", "c_name").alias("topics"),
        F.create_map(F.col("c_mktsegment"), F.col("c_nationkey")).alias("permissions"),
    )
    return nested.nested_to_text(regions)


# --- text ---------------------------------------------------------------------------


def filter_regex_any(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages")
    return pages.where(
        text.any_pattern(F.col("url"), SITE.data_paths)
        | F.contains(F.lower("html"), F.lit("python"))
    ).select("page_id", "url")


def url_parse(spark: SparkSession, d: str) -> DataFrame:
    parts = text.url_parts(F.col("url"))
    return read(spark, d, "pages").select(
        "page_id", *[c.alias(f"request_url_{name}") for name, c in parts.items()]
    )


def login_query(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(
        F.when(F.col("page_id") % 3 == 0, "/callback?next=/search?q%3D").otherwise("/home?x="),
        F.replace(F.regexp_replace("url", "[?#]", "+"), F.lit("/"), F.lit("+")),
    )
    lines = read(spark, d, "pages").select("page_id", line.alias("line"))
    event = F.when(text.is_login(F.lit(None).cast("string"), F.col("line")), "log_in")
    return lines.select(
        "page_id",
        event.alias("event"),
        F.when(event == "log_in", text.login_query(F.col("line"))).alias("log_in_query"),
    )


def request_log_build(spark: SparkSession, d: str) -> DataFrame:
    """API request log over the pages, each logged twice, with addresses of customers."""
    pages = read(spark, d, "pages")
    request = F.to_json(
        F.struct(
            F.col("url").alias("requestUrl"),
            F.lit("GET").alias("requestMethod"),
            (F.col("page_id") % 500).cast("int").alias("status"),
            F.concat(F.lit("10.0.0."), F.col("page_id")).alias("remoteIp"),
            F.length("html").alias("responseSize"),
        )
    )
    log = pages.select(
        F.col("page_id").cast("string").alias("insertId"),
        F.lit("requests").alias("logName"),
        F.timestamp_micros(F.col("page_id") * 1_000_000).alias("timestamp"),
        request.alias("httpRequest"),
        F.lit(None).cast("string").alias("spanId"),
    )
    customer, nation = read(spark, d, "customer"), read(spark, d, "nation")
    records = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.concat(F.lit("10.0.0."), F.col("c_custkey")).alias("ip"),
        F.concat(F.lit("AS"), F.col("c_custkey"), F.lit(" "), F.col("c_name"), F.lit(" Inc")).alias("org"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("region"),
        F.when(F.col("n_regionkey") > 0, F.concat(F.lit("C"), F.col("n_regionkey"))).alias("country"),
    )
    out = build_datasette_request_logs(log.unionByName(log), records, SITE, "2024-01-01")
    return out.select(
        "insert_id", "log_name", "request_method", "status", "response_size",
        "request_url_scheme", "request_url_netloc", "request_url_path", "request_url_query",
        "remote_ip", "remote_ip_asn", "remote_ip_org", "remote_ip_full_location", "partition_key",
    )


QUERIES = {
    f.__name__: f
    for f in (
        rename_columns, drop_columns, schema_diff, json_explode_array, struct_lift, json_flatten,
        nested_drop_fields, json_unpack, json_array_to_wide, nested_to_string, filter_regex_any,
        url_parse, login_query, request_log_build,
    )
}

_ORDERS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_LINES = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def _wide_sql() -> str:
    cols = []
    for slot, (c, kind, op) in enumerate(_LINE_FIELDS[:FILTER_SLOTS]):
        values = (f"'{c}'", f"'{kind}'", f"'{op}'", f"cast({c} as varchar)")
        for field, value in zip(FILTER_FIELDS, values):
            cols.append(
                f"case when (l_orderkey + l_linenumber) % 9 > {slot} then {value} end"
                f" as {filter_column(field, slot)}"
            )
    return ",\n  ".join(cols)


def _list_sql() -> str:
    """The first entries of the list as compact JSON text."""
    entries = ", ".join(
        f"""'{{"fieldName":"{c}","fieldType":"{kind}","operation":"{op}","value":"' || cast({c} as varchar) || '"}}'"""
        for c, kind, op in _LINE_FIELDS
    )
    return f"'[' || array_to_string(([{entries}])[1:cast((l_orderkey + l_linenumber) % 9 as integer)], ',') || ']'"


_URL_SQL = r"""nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '') as request_url_scheme,
  nullif(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1), '') as request_url_netloc,
  nullif(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '') as request_url_path,
  nullif(regexp_extract(url, '[?]([^#]*)', 1), '') as request_url_query"""

ORACLE = {
    "rename_columns": """select l_orderkey as request_order_key, l_linenumber as response_line_number,
  l_quantity as request_u_r_l_path, l_returnflag as insert_id, l_shipdate as shipped,
  l_tax as tax_rate from lineitem""",
    "drop_columns": """select p_partkey, p_name, p_type, p_size,
  case when p_size > 10 then p_size end as size from part""",
    "schema_diff": "\nunion all ".join(
        [f"select '{c}' as \"column\", 'left' as side, count({c}) as n_values from orders" for c in _ORDERS]
        + [f"select '{c}', 'right', count({c}) from lineitem" for c in _LINES]
    ),
    "json_explode_array": """select l_orderkey, l_linenumber, 'quantity' as name, l_quantity as count
from lineitem where l_linenumber % 4 >= 1
union all select l_orderkey, l_linenumber, 'price', l_extendedprice from lineitem where l_linenumber % 4 >= 2
union all select l_orderkey, l_linenumber, 'tax', l_tax from lineitem where l_linenumber % 4 >= 3""",
    "struct_lift": "select c_custkey as id, c_name as login, c_acctbal as starred_at from customer",
    "json_flatten": """select c_custkey as user_id, c_name as user_login, n_nationkey as user_nation_key,
  n_name as user_nation_name, n_regionkey as user_nation_attrs_region, c_acctbal as starred_at
from customer left join nation on c_nationkey = n_nationkey""",
    "nested_drop_fields": """select c_custkey as id,
  '{"key":' || n_nationkey || ',"name":"' || n_name || '"}' as nation,
  '[{"segment":"' || c_mktsegment || '"}]' as info_list, c_acctbal as starred_at
from customer left join nation on c_nationkey = n_nationkey""",
    "json_unpack": """select event_id,
  case when event_type <> 'error' then cast(regexp_extract(props, '"k": *([0-9]+)', 1) as integer) end as props_k,
  cast(null as varchar) as props_absent from events""",
    "json_array_to_wide": f"""select l_orderkey, l_linenumber,
  cast((l_orderkey + l_linenumber) % 9 as integer) as filters_total,
  {_list_sql()} as params_filters,
  {_wide_sql()}
from lineitem""",
    "nested_to_string": """select c_custkey,
  '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' as owner,
  '["' || c_mktsegment || '","' || c_name || '"]' as topics,
  '{"' || c_mktsegment || '":' || c_nationkey || '}' as permissions from customer""",
    "filter_regex_any": """select page_id, url from pages
where regexp_matches(url, '/en|/fr|.json|page=.*ref') or contains(lower(html), 'python')""",
    "url_parse": f"select page_id, {_URL_SQL} from pages",
    "login_query": """select page_id, case when page_id % 3 = 0 then 'log_in' end as event,
  case when page_id % 3 = 0 then translate(url, '?#/+', '    ') end as log_in_query from pages""",
    "request_log_build": f"""with parsed as (select page_id, html, {_URL_SQL} from pages),
ips as (select c_custkey, c_name, n_name, c_mktsegment,
    case when n_regionkey > 0 then 'C' || n_regionkey end as country
  from customer left join nation on c_nationkey = n_nationkey)
select cast(page_id as varchar) as insert_id, 'requests' as log_name, 'GET' as request_method,
  cast(page_id % 500 as integer) as status, cast(length(html) as double) as response_size,
  request_url_scheme, request_url_netloc, request_url_path, request_url_query,
  '10.0.0.' || page_id as remote_ip, 'AS' || c_custkey as remote_ip_asn,
  c_name || ' Inc' as remote_ip_org,
  n_name || ', ' || c_mktsegment || ', ' || country as remote_ip_full_location,
  '2024-01-01' as partition_key
from parsed left join ips on page_id = c_custkey
where regexp_matches(request_url_path, '/en|/fr|.json|page=.*ref')""",
}
