"""Tables of a load appear together, or not at all."""

import threading

import pytest
from pyspark.sql import functions as F
from test_sources import SITE, ips, object_log  # noqa: F401

from trafficlake.plans import run as loads
from trafficlake.schemas import Table, struct_of
from trafficlake.sinks.release import Tables

DAILY = Table("daily", struct_of("n INT, partition_key STRING"), ("n",))
WHOLE = Table("whole", struct_of("n INT"), ("n",))


def rows(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, *values):
    return spark.createDataFrame(list(values), "n int, partition_key string")


def test_all_tables_or_none(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert rows(tables.read(DAILY)) == [] and tables.days(DAILY) == []
    with tables.begin() as release:
        release.write(frame(spark, (1, "2026-01-01"), (2, "2026-01-02")), DAILY, ["2026-01-01", "2026-01-02", "2026-01-03"])
        release.write(frame(spark, (7, "x")), WHOLE)
        assert rows(tables.read(DAILY)) == [] and rows(release.read(DAILY)) == [(1, "2026-01-01"), (2, "2026-01-02")]
    assert tables.days(DAILY) == ["2026-01-01", "2026-01-02", "2026-01-03"]
    before = tables.newest()
    broken = frame(spark, (9, "2026-01-02")).withColumn("n", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"), tables.begin() as release:
        release.write(frame(spark, (5, "2026-01-01")), DAILY, ["2026-01-01"])
        release.write(broken, WHOLE)
    assert tables.newest().parts == before.parts
    assert rows(tables.read(DAILY)) == [(1, "2026-01-01"), (2, "2026-01-02")] and rows(tables.read(WHOLE)) == [(7,)]
    # a day is replaced, also by nothing; the others stay
    with tables.begin() as release:
        release.write(frame(spark, (5, "2026-01-01")), DAILY, ["2026-01-01", "2026-01-02"])
    assert rows(tables.read(DAILY)) == [(5, "2026-01-01")] and rows(tables.read(WHOLE)) == [(7,)]
    assert rows(tables.read(DAILY, first="2026-01-02")) == []
    assert rows(tables.read(DAILY, at=before)) == [(1, "2026-01-01"), (2, "2026-01-02")]
    with pytest.raises(ValueError, match="not partitioned"):
        tables.read(WHOLE, first="2026-01-01")


def test_loads_at_the_same_time_keep_both(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    with tables.begin() as one:
        one.write(frame(spark, (1, "2026-01-01")), DAILY)
        with tables.begin() as other:
            other.write(frame(spark, (2, "2026-01-02")), DAILY)
    assert rows(tables.read(DAILY)) == [(1, "2026-01-01"), (2, "2026-01-02")] and tables.newest().number == 2


def test_folders_nobody_names_go(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for n in range(4):
        with tables.begin() as release:
            release.write(frame(spark, (n, "2026-01-01")), DAILY)
    assert len(tables.drop_unused(keep=2)) == 2
    assert rows(tables.read(DAILY)) == [(3, "2026-01-01")] and tables.newest().number == 4


def test_whole_load(spark, tmp_path, object_log, ips):  # noqa: F811
    source, out, plain = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "plain")
    source.mkdir()
    (source / "object_log").symlink_to(object_log)
    ips.write.parquet(f"{source}/ip_dimension")
    load = loads.Load(spark, str(source), out, SITE)
    done = loads.published(load, "s3")
    assert done == loads.run(loads.Load(spark, str(source), plain, SITE), "s3") and len(done) == 5
    tables = Tables(spark, out)
    for name in done:
        stored = loads.read_table(spark, plain, name)
        assert sorted(map(str, tables.read(name).collect())) == sorted(map(str, stored.collect()))
    assert load.written["core_s3_logs"] == tables.read("core_s3_logs").count() == 14


def test_sources_at_the_same_time(spark, tmp_path, monkeypatch):
    meet = threading.Barrier(2, timeout=60)

    def source(name, fails=False):
        def load(part):
            meet.wait()  # comes back only if another source runs at the same time
            if fails:
                raise ValueError("no data")
            part.write({name: spark.createDataFrame([("1",)], "id string")})
            return [name]

        return load

    sources = {"a": source("core_github_forks"), "b": source("core_github_stargazers", fails=True)}
    monkeypatch.setattr(loads, "DAILY", sources)
    monkeypatch.setattr(loads, "FULL_HISTORY", {})
    load = loads.Load(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    with pytest.raises(loads.LoadsFailedError, match="b: no data") as failed:
        loads.run_together(load, publish=True, at_once=2)
    assert failed.value.done == {"a": ["core_github_forks"]} and set(failed.value.errors) == {"b"}
    tables = Tables(spark, load.target)
    assert tables.read("core_github_forks").count() == 1 and tables.read("core_github_stargazers").count() == 0
