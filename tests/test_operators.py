"""Operators against brute force, and the edge cases of the stated semantics."""

import datetime as dt
import random
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.functions import nested, numbers, text, times
from trafficlake.operators import columns as C
from trafficlake.operators import dedup, joins, quality, reports, sessions, summaries
from trafficlake.operators.enrich import IP_RECORD, resolve_addresses, resolve_durably
from trafficlake.schemas import REGISTRY, Table, UnknownTableError, struct_of
from trafficlake.sinks.append import append_new, new_rows
from trafficlake.sinks.parquet import read_table, write_table
from trafficlake.site import Site
from trafficlake.sources.tables import read_jdbc_table

T0 = dt.datetime(2024, 1, 1)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# --- columns ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name,expected",
    [("CamelCase", "camel_case"), ("Single", "single"), ("S", "s"), ("requestURLPath", "request_u_r_l_path")],
)
def test_snake_case(spark, name, expected):
    df = spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType())]))
    assert C.to_snake_case(df).columns == [expected]


def test_conform(spark):
    df = spark.createDataFrame(
        [("a", None, {"x": 1}, 5)], "insert_id string, score string, tags map<string,int>, extra int"
    )
    out = C.conform(df, "core_viewer_hits", "2024-01-01")
    assert out.schema.names == REGISTRY["core_viewer_hits"].columns
    assert out.first().asDict() == {
        "insert_id": "a", "timestamp": None, "name": None, "score": None,
        "tags": '{"x":1}', "partition_key": "2024-01-01",
    }
    with pytest.raises(UnknownTableError):
        C.conform(df, "fake_name")
    bad = df.withColumn("score", F.lit("bad"))
    with pytest.raises(Exception, match="score takes no value like: bad"):
        C.conform(bad, "core_viewer_hits").collect()
    assert {r.column: r.n_failed for r in C.failed_casts(bad, "core_viewer_hits").collect()} == {"insert_id": 0, "score": 1}


def test_unreadable_times_fail(spark):
    df = spark.createDataFrame([("2024-01-01",), (None,)], "t string")
    good = df.select(times.readable(F.col("t"), times.iso_date(F.col("t")), "date").alias("d"))
    assert {str(r.d) for r in good.collect()} == {"2024-01-01", "None"}
    with pytest.raises(Exception, match="unreadable timestamp: nonsense"):
        df.select(times.readable(F.lit("nonsense"), times.iso_time(F.lit("nonsense")))).collect()


def test_distinct_by_key_compares_values(spark):
    rows = [("k", "a", None), ("k", "a", None), ("m", None, "b")]
    df = spark.createDataFrame(rows, "id string, x string, y string")
    assert dedup.distinct_by_key(df, ["id"]).count() == 2
    swapped = df.union(spark.createDataFrame([("k", None, "a")], df.schema))
    with pytest.raises(Exception, match="different rows share a key"):
        dedup.distinct_by_key(swapped, ["id"]).select("id", "x").collect()


def test_nullable_twins(spark):
    df = spark.createDataFrame([(1, 2, True, 3)], "views int, viewsNullable int, hasViews boolean, other int")
    assert C.drop_twins(df).first().asDict() == {"views": 2, "other": 3}


def test_union_and_coalesce_of_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert sorted(map(tuple, C.union_all(a, b).collect()), key=str) == [(1, "x", None), (None, "y", 2.0)]
    assert a.select(C.coalesce_present(a, "p", "q").alias("v")).first().v is None


# --- text, numbers, times -----------------------------------------------------------


def test_url_parts(spark):
    def parts(url):
        return one(spark, *[c.alias(n) for n, c in text.url_parts(F.lit(url)).items()]).asDict()

    assert parts("https://data.example.org/ferc1/f1_cash_flow") == {
        "scheme": "https", "netloc": "data.example.org", "path": "/ferc1/f1_cash_flow", "query": None,
    }
    assert parts("HTTP://h?a=b#c")["scheme"] == "http" and parts("HTTP://h?a=b#c")["query"] == "a=b"
    assert parts("/x y?q|=1") == {"scheme": None, "netloc": None, "path": "/x y", "query": "q|=1"}
    assert parts("") == dict.fromkeys(("scheme", "netloc", "path", "query"))


def test_split_key(spark):
    def split(key):
        return tuple(one(spark, text.version_of(F.lit(key)).alias("v"), text.table_of(F.lit(key)).alias("t")))

    assert split("stable/a/b.parquet") == ("stable", "a/b.parquet")
    assert split("whole") == ("whole", None)
    assert split("-") == (None, None)
    assert split("/t") == (None, "t")


def test_numbers(spark):
    row = one(
        spark,
        numbers.number_or_null(F.lit("12x")).alias("bad"),
        numbers.number_or_null(numbers.dash_to_zero(F.lit("-"))).alias("dash"),
        numbers.share(F.lit(1.0), F.lit(0.0)).alias("none"),
    )
    assert tuple(row) == (None, 0.0, None)


def test_access_log_time(spark):
    at = times.access_log_time(F.lit("[06/Feb/2019:00:00:38"), F.lit("-0130]"))
    assert one(spark, at.alias("t")).t == dt.datetime(2019, 2, 6, 1, 30, 38)
    bad = times.access_log_time(F.lit("-"), F.lit("-"))
    assert one(spark, bad.alias("t")).t is None
    assert one(spark, times.day_start(F.lit("2024-02-29")).alias("t")).t == dt.datetime(2024, 2, 29)
    assert one(spark, times.day_start(F.lit(None).cast("string")).alias("t")).t is None
    with pytest.raises(Exception, match="unreadable timestamp: 2024-02-30"):
        one(spark, times.day_start(F.lit("2024-02-30")).alias("t"))


def test_json_list(spark):
    shape = "struct<a: int>"
    texts = {'[{"a": 1}]': [1], "[]": [], '{"a": 1}': None, "junk": None, " [{}]": [None]}
    for given, expected in texts.items():
        got = one(spark, nested.json_list(F.lit(given), shape).alias("l"), nested.is_bad_json_list(F.lit(given), shape).alias("bad"))
        assert (None if got.l is None else [x.a for x in got.l]) == expected
        assert got.bad == (expected is None)


# --- sessions -----------------------------------------------------------------------


def brute_sessions(rows, gap=1800):
    out, last, number = {}, {}, {}
    for i, pk, user, ts in sorted(rows, key=lambda r: (r[3] is not None, r[3] or T0, r[0])):
        if user is None:
            out[i] = None
            continue
        before = last.get((pk, user))
        if before is not None and ts is not None and (ts - before).total_seconds() > gap:
            number[pk, user] += 1
        number.setdefault((pk, user), 1)
        last[pk, user] = ts
        out[i] = f"{pk}-s{number[pk, user]}"
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sessions_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        user = None if rng.random() < 0.1 else ("hot" if hot else f"u{rng.randrange(8)}")
        seconds = rng.choice([0, 1799, 1800, 1801]) * rng.randrange(30) + rng.choice([0, 0, 0.5])
        base = T0 if rng.random() < 0.8 else dt.datetime(1969, 12, 31, 20)
        ts = None if rng.random() < 0.02 else base + dt.timedelta(seconds=seconds)
        rows.append((i, f"2024-01-0{rng.randrange(1, 4)}", user, ts))
    df = spark.createDataFrame(rows, "id int, partition_key string, user_id string, timestamp timestamp")
    out = sessions.with_sessions(df)
    assert out.columns == [*df.columns, "session_id"]
    assert {r.id: r.session_id for r in out.collect()} == brute_sessions(rows)


def test_gap_of_thirty_minutes_stays_in_the_session(spark):
    at = [T0, T0 + dt.timedelta(minutes=30), T0 + dt.timedelta(minutes=60, seconds=1)]
    df = spark.createDataFrame([("p", "u", t) for t in at], "partition_key string, user_id string, timestamp timestamp")
    got = [r.session_id for r in sessions.with_sessions(df).orderBy("timestamp").collect()]
    assert got == ["p-s1", "p-s1", "p-s2"]


# --- joins and de-duplication -------------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"hot_keys": 2}])
def test_many_to_one(spark, options):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "zz", None])) for i in range(3000)]
    dim = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), (None, 9)], "k string, v int").where("k is not null")
    out = joins.many_to_one(spark.createDataFrame(rows, "id int, k string"), dim, ["k"], **options)
    want = {"a": 1, "c": 3}
    assert sorted(map(tuple, out.select("id", "k", "v").collect())) == sorted(
        ((i, k, want.get(k)) for i, k in rows), key=lambda r: r[0])
    with pytest.raises(Exception, match="dimension key repeats"):
        joins.many_to_one(out.select("id", "k"), dim.union(dim), ["k"]).collect()


def test_keep_first_and_distinct(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("b", 5, "z"), (None, 1, "n")], "k string, o int, v string")
    got = dedup.keep_first(df, ["k"], [F.col("o"), F.col("v")]).collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1, "y"), ("b", 5, "z"), (None, 1, "n")]
    assert dedup.distinct_rows(df).count() == 4
    assert dedup.latest(df, [F.col("o").desc(), F.col("v")]).first().k == "b"


def test_mode(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "y"), ("a", None), ("b", "q"), ("b", "p"), ("c", None)]
    out = summaries.mode_per_group(spark.createDataFrame(rows, "g string, v string"), ["g"], "v")
    assert {r.g: r.v for r in out.collect()} == {"a": "y", "b": "p", "c": None}


def test_resolve_distinct_addresses(spark):
    logs = spark.createDataFrame([("1.1.1.1",), ("1.1.1.1",), (None,), ("2.2.2.2",)], "remote_ip string")
    known = spark.createDataFrame([("2.2.2.2",)], "ip string")

    def lookup(batch):
        return [{"ip": ip, "org": "AS1 Org", "anycast": True} for ip in batch]

    found = resolve_addresses(logs, lookup, known).collect()
    assert [(r.ip, r.org, r.anycast, r.city) for r in found] == [("1.1.1.1", "AS1 Org", True, None)]
    assert len(IP_RECORD.split(", ")) == 14


def test_lookup_is_taken_up_where_it_failed(spark, tmp_path):
    logs = spark.createDataFrame([(f"10.0.0.{i % 40}",) for i in range(200)] + [(None,)], "remote_ip string")
    store, asked = str(tmp_path / "ips"), tmp_path / "asked"
    asked.mkdir()

    def lookup(batch, limit):
        if len(list(asked.iterdir())) >= limit:
            raise ConnectionError("quota")
        (asked / uuid.uuid4().hex).write_text("\n".join(batch))
        return [{"ip": ip, "org": f"AS1 {ip}"} for ip in batch]

    def go(limit):
        return resolve_durably(logs, lambda b: lookup(b, limit), store, call_size=8, tries=2, pause=0.01)

    with pytest.raises(Exception, match="quota"):
        go(3)
    told = spark.read.parquet(store).count()
    assert 0 < told < 40
    assert go(100) == 40 - told and go(100) == 0
    calls = [line for f in asked.iterdir() for line in f.read_text().split()]
    assert sorted(calls) == sorted({f"10.0.0.{i}" for i in range(40)})  # each address asked once
    assert {r.ip: r.org for r in spark.read.parquet(store).collect()} == {ip: f"AS1 {ip}" for ip in calls}
    start = time.monotonic()
    other = spark.createDataFrame([(f"11.0.0.{i}",) for i in range(3)], "remote_ip string")
    assert resolve_durably(other, lambda b: lookup(b, 99), store, call_size=1, calls_per_second=2) == 3
    assert time.monotonic() - start >= 1.0


def test_append_of_fresh_keys_reads_no_stored_key(spark, tmp_path):
    target = Table("fresh", struct_of("n BIGINT, v STRING"), ("n",))
    frame = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "n long, v string")
    assert append_new(frame(*range(100)), str(tmp_path), target) == 100
    new = new_rows(frame(200, 300), str(tmp_path), target)
    new.collect()
    scans = [line for line in new._jdf.queryExecution().toString().splitlines() if "FileScan parquet" in line]
    assert any("GreaterThanOrEqual(n,200)" in line and "LessThanOrEqual(n,300)" in line for line in scans)
    assert append_new(frame(99, 100, 101), str(tmp_path), target) == 2
    assert append_new(frame(5, 101), str(tmp_path), target) == 0 and append_new(frame(), str(tmp_path), target) == 0
    with pytest.raises(Exception, match="fresh: key repeats"):
        append_new(frame(500, 500), str(tmp_path), target)
    assert spark.read.parquet(f"{tmp_path}/fresh").count() == 102


# --- quality ------------------------------------------------------------------------


def test_unique_and_mapped(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "k string, n int")
    quality.require_unique(df, ["k", "n"])
    with pytest.raises(quality.DataQualityError):
        quality.require_unique(df, ["k"])
    for check in (quality.unique_or_fail, quality.unique_by_counts):
        assert check(df, ["k", "n"]).count() == 3
        for use in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("n").collect(), lambda d: d.select(F.lit(1)).collect()):
            with pytest.raises(Exception, match="key repeats.*a"):
                use(check(df, ["k"]))
    quality.require_balance("x", 3, {"a": 1, "b": 2})
    with pytest.raises(quality.DataQualityError, match="3 rows read"):
        quality.require_balance("x", 3, {"a": 1, "b": 1})
    known = spark.createDataFrame([("a",)], "id string")
    assert [r.k for r in quality.unmapped(df, "k", known, "id").collect()] == [None]
    named = df.select(quality.mapped_or_fail(F.col("k"), joins.map_values(F.col("k"), {"a": "A"}), "k").alias("m"))
    with pytest.raises(Exception, match="no mapping for k: NULL"):
        named.collect()


def test_schema_check(spark):
    target = Table("t", T.StructType.fromDDL("id string, n int, doi string, gone int"), ("id",))
    df = spark.createDataFrame([(None, "1", "10.5281/zenodo.5", 1), ("b", "x", "no", 2)], "id string, n string, doi string, more int")
    out = quality.schema_check(df, target, {"doi": r"10\.5281/zenodo\.\d+"})
    assert {r.rule: r.n_broken for r in out.collect()} == {
        "id: null key": 1, "n: type": 1, "doi: pattern": 1, "gone: missing": 2, "more: not registered": 2}


# --- reports ------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["normal", "exp", "ties", "one", "two", "wide", "infinite"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=700),
        "exp": np.exp(rng.normal(size=500) * 6),
        "ties": np.repeat([1.0, 2.0, 5.0], [400, 30, 7]),
        "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]),
        "wide": np.array([-1e300, -0.0, 0.0, -5.0, 1e-300, 5.0, 1e300]),
        "infinite": np.array([-np.inf, *rng.normal(size=50), *[2.0] * 60, np.inf]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = reports.quantiles(df, "v", probabilities)
    ordered = np.sort(values).tolist()
    want = []
    for at in [p * (len(ordered) - 1) for p in probabilities]:
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        want.append(low if at == int(at) else low + (high - low) * (at - int(at)))
    assert np.allclose(got, want, rtol=1e-12)


def test_quantiles_of_many_values_in_two_passes(spark, tmp_path, monkeypatch):
    """Brackets, gaps between them and the search inside, with almost nothing allowed on the driver."""
    for name, value in (("COLLECTED", 20), ("SPLITS", 4), ("SKETCH", 50)):
        monkeypatch.setattr(reports, name, value)
    rng = np.random.default_rng(8)
    values = np.concatenate((rng.normal(size=3000), np.full(2500, 0.25), [np.inf, -np.inf], np.exp(9 * rng.normal(size=800))))
    rng.shuffle(values)
    spark.createDataFrame([(float(v),) for v in values], "v double").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    read = df.sparkSession.sparkContext.accumulator(0)
    counted = df.mapInPandas(lambda batches: (b for b in batches if read.add(len(b)) is None), "v double")
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = reports.quantiles(counted, "v", probabilities)
    ordered = np.sort(values)
    for p, found in zip(probabilities, got, strict=True):
        at = p * (len(ordered) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        assert found == low if at == int(at) else np.isclose(found, low + (high - low) * (at - int(at)), rtol=1e-12)
    assert read.value == 2 * len(values)
    assert reports.quantiles(df.limit(0), "v") == [None] * 3


def test_resample_fills_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 5), 1), (dt.datetime(2024, 4, 30), 2), (None, 3)], "t timestamp, n int")
    months = reports.resample_monthly(df, "t", F.sum("n").alias("n")).orderBy("period").collect()
    assert [(str(r.period), r.n) for r in months] == [
        ("2024-01-31", 1), ("2024-02-29", 0), ("2024-03-31", 0), ("2024-04-30", 2)]
    weeks = reports.resample_weekly(df, "t", F.count("n").alias("n")).orderBy("period").collect()
    assert str(weeks[0].period) == "2024-02-04" and len(weeks) == 14 and sum(r.n for r in weeks) == 2


# --- sinks, sites -------------------------------------------------------------------


def hits(spark, *rows):
    return spark.createDataFrame(list(rows), "insert_id string, score double, partition_key string")


def test_write_replaces_only_its_days(spark, tmp_path):
    base = str(tmp_path)
    write_table(hits(spark, ("a", 1.0, "2024-01-01"), ("b", 2.0, "2024-01-02")), base, "core_viewer_hits")
    write_table(hits(spark, ("c", 3.0, "2024-01-02")), base, "core_viewer_hits", ["2024-01-02", "2024-01-03"])
    got = read_table(spark, base, "core_viewer_hits")
    assert sorted((r.insert_id, r.partition_key) for r in got.collect()) == [("a", "2024-01-01"), ("c", "2024-01-02")]
    # a re-run without rows empties the day
    write_table(hits(spark, ("x", 0.0, "-")).where("false"), base, "core_viewer_hits", ["2024-01-01"])
    assert [r.insert_id for r in read_table(spark, base, "core_viewer_hits").collect()] == ["c"]
    one_day = read_table(spark, base, "core_viewer_hits", "2024-01-02", "2024-01-02")
    assert "PartitionFilters: [isnotnull(partition_key" in one_day._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        read_table(spark, base, "core_github_forks", "2024-01-01")
    with pytest.raises(UnknownTableError):
        write_table(one_day, base, "fake_name")


def test_append_skips_known_keys(spark, tmp_path):
    base = str(tmp_path)
    assert append_new(hits(spark, ("a", 1.0, "2024-01-01")), base, "core_viewer_hits") == 1
    assert append_new(hits(spark, ("a", 9.0, "2024-01-01"), ("b", 2.0, "2024-01-02")), base, "core_viewer_hits") == 1
    assert append_new(hits(spark, ("a", 9.0, "2024-01-01")), base, "core_viewer_hits") == 0
    got = read_table(spark, base, "core_viewer_hits").collect()
    assert sorted((r.insert_id, r.score) for r in got) == [("a", 1.0), ("b", 2.0)]
    with pytest.raises(quality.DataQualityError):
        append_new(hits(spark, ("z", 1.0, "2024-01-01"), ("z", 2.0, "2024-01-01")), base, "core_viewer_hits")


def test_partition_of_unpartitioned_database_table_is_an_error(spark):
    with pytest.raises(ValueError, match="not partitioned"):
        read_jdbc_table(spark, "core_github_forks", {}, "2024-01-01")


def test_site_from_json(tmp_path):
    path = tmp_path / "site.json"
    path.write_text('{"internal_requesters": ["x"], "dataset_slugs": {"5": "five"}}')
    site = Site.from_json(str(path))
    assert site.internal_requesters == ("x",) and site.all_dataset_slugs["5"] == "five"
    path.write_text('{"unknown": 1}')
    with pytest.raises(ValueError):
        Site.from_json(str(path))
