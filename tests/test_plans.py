"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from trafficlake.operators import dedup, joins, sessions
from trafficlake.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", ["popular", "traffic_series", "stargazers", "forks", "dataset_snapshot", "archive_stats"])
def test_sources_are_evaluated_once(spark, name):
    """The key check of a source plan is in the same scan as its rows, whatever is asked of them."""
    df = QUERIES[f"{name}_build"](spark, SF_DIR)
    for asked in (df, df.select(F.lit(1)), df.groupBy().count()):
        text = plan(asked)
        assert text.count("FileScan parquet") == 1 and "raise_error" in text


def test_summaries_from_one_scan_of_the_log(spark):
    text = plan(QUERIES["daily_summaries_at_once"](spark, SF_DIR))
    assert text.count("FileScan parquet") == 2 and "Expand" in text  # the log and the dimension
    for name in ("event_demux", "validate_records", "topk_value_share"):
        assert plan(QUERIES[name](spark, SF_DIR)).count("FileScan parquet") == 1, name


def test_stored_dimension_is_sent_before_any_shuffle(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(str(tmp_path / "dim"))
    spark.range(1000).selectExpr("cast(id % 3 as string) as k").write.parquet(str(tmp_path / "rows"))
    rows, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "dim"))
    text = plan(joins.many_to_one(rows, dim, ["k"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(k" not in text.split("Subquery")[0]


def test_filters_reach_the_scan(spark):
    for name, column in (("scan_partition", "ts"), ("scan_week_window", "ts"), ("scan_time_range", "o_orderdate")):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert f"GreaterThanOrEqual({column}" in text and f"LessThan({column}" in text, name


def test_scans_read_needed_columns_only(spark):
    text = plan(QUERIES["key_violations"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_object_log_dedup_hashes_in_one_shuffle(spark):
    df = spark.createDataFrame([("a", "k", 1)], "id string, partition_key string, n int").repartition(3)
    out = dedup.distinct_by_key(df, ["partition_key", "id"])
    text = plan(out)
    # the one value of the check's subquery aside, all aggregates hash
    assert text.count("SortAggregate(") == text.count("SortAggregate(key=[],") and "SortMergeJoin" not in text
    assert "HashAggregate(keys=[" in text or "HashAggregate(key" in text


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    text = plan(dedup.keep_first(df, ["k"], [F.col("id")]))
    assert "WindowGroupLimit" in text and "Partial" in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return plan(df), rows


def test_hot_key_of_a_lookup_is_split(spark, skew_conf):
    rows = spark.range(0, 200_000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = joins.many_to_one(rows, dim, ["k"])
    text, got = final_plan(out)
    assert "skew=true" in text
    assert len(got) == 200_000 and all(r.v == r.k * 2 for r in got)


def test_null_keys_are_spread(spark, skew_conf):
    rows = spark.range(0, 100_000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    out = joins.many_to_one(rows, dim, ["k"])
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 100_000 and max(sizes) < 2 * 100_000 / len(sizes)


@pytest.mark.parametrize("busy_seconds", [86_400, 1_200])
def test_hot_user_of_sessions_is_split(spark, skew_conf, busy_seconds):
    """Half of the rows belong to one user, all day long or within one half hour."""
    hot = F.col("id") % 2 == 0
    events = spark.range(0, 200_000, 1, 16).select(
        "id",
        F.lit("p").alias("partition_key"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("user_id"),
        F.timestamp_seconds(F.when(hot, F.col("id") % busy_seconds).otherwise(F.col("id") % 86_400)).alias("timestamp"),
    )
    out = sessions.with_sessions(events)
    text, got = final_plan(out)
    assert len(got) == 200_000
    assert {r.session_id for r in got if r.user_id == "hot"} == {"p-s1"}
    # the window sees one row per half hour; the events only meet its result in a join
    final = text[: text.index("== Initial Plan ==")]
    assert final.count("Window [") == 2 and final.index("HashAggregate") > final.index("Window [")
    if busy_seconds < 1_800:
        assert "skew=true" in final
    else:
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 200_000 / 3
