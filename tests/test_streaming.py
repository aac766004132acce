"""Incremental loads, sessions and summaries give the tables of the batch load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_sources import SITE, ips, line, object_log, put  # noqa: F401

from trafficlake.operators.sessions import with_sessions
from trafficlake.operators.summaries import summary_by_db, summary_by_table, summary_by_user
from trafficlake.plans import objectlog
from trafficlake.sinks.parquet import read_table
from trafficlake.sources import files
from trafficlake.streaming import incremental
from trafficlake.streaming import summaries as late
from trafficlake.streaming.sessions import SessionStore, closed_sessions
from trafficlake.streaming.summaries import SummaryStore


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_incremental_load_equals_batch(spark, tmp_path, object_log, ips):  # noqa: F811
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def load():
        stream = incremental.core_stream(spark, object_log, ips)
        incremental.append_available(stream, out, "core_s3_logs", check).awaitTermination()
        return read_table(spark, out, "core_s3_logs")

    batch = objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips)
    assert rows(load()) == rows(batch)
    assert load().count() == 14  # nothing new
    put(f"{object_log}/2026-03-02-00", line("R40", time="02/Mar/2026:00:00:00") + line(
        time="02/Mar/2026:00:00:01", zone="+0000", request="R41"))
    assert load().count() == 16
    # far behind every other row, and an id that is stored under another day already
    put(f"{object_log}/2018-01-01-00", line("R70", time="01/Jan/2018:00:00:00"))
    put(f"{object_log}/2026-03-03-00", line("R40", time="02/Mar/2026:00:00:00"))
    everything = objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips)
    assert rows(load()) == rows(everything) and everything.count() == 18


def test_summary_stream_emits_closed_days(spark, tmp_path, object_log, ips):  # noqa: F811
    put(f"{object_log}/2026-03-09-00", line("R50", time="09/Mar/2026:00:00:00"))
    found = []
    core = incremental.core_stream(spark, object_log, ips)
    usage = incremental.usage_stream(core, SITE)
    query = incremental.load_available(
        incremental.summary_stream(usage, "1 hour"),
        lambda batch, _: found.extend(batch.collect()), str(tmp_path / "check"))
    query.awaitTermination()
    batch = summary_by_table(objectlog.usage_rows(
        objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips), SITE), "partition_key")
    closed = batch.where("time < '2026-03-09'")
    assert sorted((r["table"], r["request_count"], str(r["time"])) for r in found) == sorted(
        (r["table"], r["request_count"], str(r["time"])) for r in closed.collect())


def at(second, micros=0):
    return dt.datetime(2026, 3, 1, 8) + dt.timedelta(seconds=second, microseconds=micros)


def put_events(spark, folder, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(folder)


EVENTS = "insert_id string, user_id string, timestamp timestamp, partition_key string"
HALF_HOUR = 1800


def event_sets():
    edges = [("a", at(0)), ("a", at(HALF_HOUR - 1, 999999)), ("b", at(0)), ("b", at(HALF_HOUR)), ("c", at(0)), ("c", at(HALF_HOUR, 1))]
    draw = random.Random(6)
    edges += [(draw.choice(["d", "e", None]), at(draw.randrange(30000))) for _ in range(120)]
    return [(str(i), user, t, "2026-03-01" if t < at(20000) else "2026-03-02") for i, (user, t) in enumerate(edges)]


def test_stored_sessions_in_any_order(spark, tmp_path):
    events = event_sets()
    want = rows(with_sessions(spark.createDataFrame(events, EVENTS)))
    first = {(r.user_id, r.session_id[-1]) for r in with_sessions(spark.createDataFrame(events[:6], EVENTS)).collect()}
    assert first == {("a", "1"), ("b", "1"), ("c", "1"), ("c", "2")}
    for seed in (1, 2):
        folder, check = str(tmp_path / f"in{seed}"), str(tmp_path / f"check{seed}")
        store = SessionStore(spark, str(tmp_path / f"sessions{seed}"))
        late = random.Random(seed).sample(events, len(events))
        for k in range(0, len(late), 50):
            put_events(spark, folder, late[k : k + 50])
            store.merge_available(spark.readStream.schema(EVENTS).parquet(folder), check).awaitTermination()
        store.merge(spark.createDataFrame(late[:30], EVENTS))  # again: nothing changes
        assert store.merge(spark.createDataFrame(late[:0], EVENTS)) == []
        assert rows(store.with_sessions(spark.createDataFrame(events, EVENTS))) == want
    assert SessionStore(spark, str(tmp_path / "none")).with_sessions(spark.createDataFrame(events, EVENTS)).count() == len(events)


def test_closed_sessions_part_after_half_an_hour(spark, tmp_path):
    folder, found = str(tmp_path / "in"), []
    put_events(spark, folder, event_sets()[:6])
    put_events(spark, folder, [("x", "z", at(10**6), "2026-03-12")])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    incremental.load_available(
        closed_sessions(stream, lateness="1 hour"), lambda batch, _: found.extend(batch.collect()), str(tmp_path / "check")
    ).awaitTermination()
    assert sorted((r.user_id, r.first, r.last, r.n_events) for r in found) == [
        ("a", at(0), at(HALF_HOUR - 1, 999999), 2), ("b", at(0), at(HALF_HOUR), 2),
        ("c", at(0), at(0), 1), ("c", at(HALF_HOUR, 1), at(HALF_HOUR, 1), 1)]


def test_summaries_with_late_rows_in_any_split(spark, tmp_path, object_log, ips):  # noqa: F811
    usage = objectlog.build_out_s3_logs(objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips), SITE)
    usage = usage.unionByName(usage.withColumn("id", F.concat("id", F.lit("-2"))).withColumn("megabytes_sent", F.lit(0.25)))
    kept = spark.createDataFrame(usage.collect(), usage.schema)
    want = {
        "by_table": rows(rounded(summary_by_table(kept, "partition_key"))),
        "by_user": rows(rounded(summary_by_user(kept, "partition_key"))),
        "by_db": rows(rounded(summary_by_db(kept, "partition_key"))),
    }
    for seed in (1, 2):
        store = SummaryStore(spark, str(tmp_path / f"out{seed}"))
        part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3))
        added = [store.add(kept.where(part == k), k) for k in (2, 0, 1)]
        assert sum(added) == kept.count()
        # a batch run again under its number or another, and rows taken in and back out
        assert store.add(kept.where(part == 0), 1) == 0 and store.add(kept, 7) == 0 and store.add(kept.limit(0), 8) == 0
        store.retract(kept.where(part == 1), 20)
        again = kept.where(part == 1).withColumn("id", F.concat("id", F.lit("-3")))
        assert store.add(again, 21) == again.count()
        for kind, expected in want.items():
            made = read_table(spark, store.target, f"out_s3_daily_summary_{kind}")
            names = [c for c in rounded(SUMMARY[kind](kept, "partition_key")).columns]
            assert rows(rounded(made.select(*names))) == expected


def test_failed_summary_batch_is_run_again(spark, tmp_path, object_log, ips, monkeypatch):  # noqa: F811
    usage = objectlog.build_out_s3_logs(objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips), SITE)
    want = rows(rounded(summary_by_table(usage, "partition_key")))
    store = SummaryStore(spark, str(tmp_path / "out"))
    for step in ("append_staged", "write_table"):  # lost after the part, then after the rows
        with monkeypatch.context() as patch, pytest.raises(InterruptedError):
            patch.setattr(late, step, lambda *_: (_ for _ in ()).throw(InterruptedError()))
            store.add(usage, 0)
    store.add(usage, 0)
    made = read_table(spark, store.target, "out_s3_daily_summary_by_table")
    names = rounded(summary_by_table(usage, "partition_key")).columns
    assert rows(rounded(made.select(*names))) == want


def rounded(df):
    return df.withColumns({"normalized_file_downloads": F.round("normalized_file_downloads", 6), "request_count": F.col("request_count").cast("int"),
                           "time": F.col("time").cast("timestamp")})


SUMMARY = {"by_table": summary_by_table, "by_user": summary_by_user, "by_db": summary_by_db}
