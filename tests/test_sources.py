"""Each source end to end on small hand-written files."""

import json
import os

import pytest
from pyspark.errors import PySparkException

from trafficlake.plans import objectlog, repository, requests, snapshots, viewer
from trafficlake.plans.run import Load, load_client_log, run
from trafficlake.schemas import REGISTRY
from trafficlake.sinks.parquet import read_table, write_table
from trafficlake.site import Site
from trafficlake.sources import files

SITE = Site(
    internal_requesters=("arn:own/sync",),
    viewer_referer_prefix="https://viewer.example.org/",
    docs_referer_pattern="docs.example.org",
    usage_cutoff="2026-01-01",
    dataset_slugs={"1": "first_set"},
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)


def line(request="R1", time="06/Feb/2019:00:00:38", zone="+0000", ip="1.2.3.4", requester="-",
         operation="REST.GET.OBJECT", key="stable/core_a.parquet", status="200", sent="2000000",
         size="4000000", referer='"-"', agent='"Mozilla ""quoted"" 5.0"', region=None):
    fields = ["owner", "bucket", f"[{time}", f"{zone}]", ip, requester, request, operation, key,
              f'"GET /{key} HTTP/1.1"', status, "-", sent, size, "12", "-", referer, agent, "-",
              "host", "SigV4", "ECDHE", "AuthHeader", "s3.host", "TLSv1.2", "-", "-"]
    return " ".join(fields + ([region] if region else [])) + "\n"


@pytest.fixture
def object_log(tmp_path):
    root = str(tmp_path / "object_log")
    put(f"{root}/2026-02-25-00-10", "".join([
        line(),
        line(),  # repeated row
        line(region="us-west-2"),  # 28 fields, equal to the rows above without the region
        line("R2", ip="-", sent="-", size="-", key="nightly/db.sqlite.gz"),
        line("R3", sent="500", size="0", referer='"https://viewer.example.org/x"'),
        line("R4", operation="S3.TRANSITION_INT.OBJECT"),
        line("R5", requester="arn:own/sync"),
        line("R6", key="-", operation="REST.GET.BUCKET"),
        line("R7", key="viewer-bucket/core_b.parquet"),
        line("R8", key="viewer-bucket/core_b.parquet", referer='"https://docs.example.org/p"',
             zone="-0200", time="25/Feb/2026:23:00:00"),
        line("R9", key="/x.parquet", ip="9.9.9.9"),
        line("R10", key="stable/old_hourly_emissions/p"),
        line("R11", key="stable/app.js"), line("R12", key="stable/hourly_emissions_epacems/p"),
        line("R13", key="stable/.env"), line("R14", status="4xx", size="bad", sent="7"),
    ]))
    put(f"{root}/2025-12-31-23-00", line("R20", key="viewer-bucket/core_b.parquet"))
    put(f"{root}/2026-02-26-00-00", "")
    return root


@pytest.fixture
def ips(spark):
    return spark.createDataFrame(
        [("1.2.3.4", "AS1 Some Org Inc", "Town", "State", "US", "5.5", "United States", True),
         ("9.9.9.9", "AS2", "Town", None, "CH", None, "Switzerland", False)],
        "ip string, org string, city string, region string, country string, latitude string, "
        "country_name string, isEU boolean",
    )


def by(df, key="request_id"):
    return {r[key]: r for r in df.collect()}


def test_unreadable_time_fails_the_load(spark, tmp_path, ips):
    for time in ("06-Feb-2019:00:00:38", "-"):
        root = str(tmp_path / f"log{time[0]}")
        put(f"{root}/2026-02-25-00-10", line() + line("R2", time=time))
        with pytest.raises(PySparkException, match="unreadable timestamp"):
            objectlog.build_core_s3_logs(files.object_log(spark, root), ips).collect()


def test_object_log_to_typed_rows(spark, object_log, ips):
    raw = files.object_log(spark, object_log)
    assert raw.count() == 17
    core = objectlog.build_core_s3_logs(raw, ips)
    assert core.columns == REGISTRY["core_s3_logs"].columns
    assert core.count() == 14  # two copies and the life-cycle row are gone
    rows = by(core)
    assert rows["R1"]["id"] == "R1_REST.GET.OBJECT_stable/core_a.parquet"
    assert str(rows["R1"]["time"]) == "2019-02-06 00:00:38"
    assert rows["R1"]["megabytes_sent"] == 2.0
    assert rows["R1"]["normalized_file_downloads"] == 0.5
    assert rows["R1"]["user_agent"] == 'Mozilla "quoted" 5.0'
    assert rows["R1"]["remote_ip_asn"] == "AS1"
    assert rows["R1"]["remote_ip_org"] == "Some Org Inc"
    assert rows["R1"]["remote_ip_full_location"] == "Town, State, US"
    assert rows["R1"]["remote_ip_latitude"] == 5.5
    assert rows["R2"]["remote_ip"] is None and rows["R2"]["megabytes_sent"] == 0.0
    assert rows["R2"]["object_size"] is None and rows["R2"]["normalized_file_downloads"] is None
    assert rows["R3"]["normalized_file_downloads"] is None  # size 0
    assert str(rows["R8"]["time"]) == "2026-02-26 01:00:00"
    assert rows["R9"]["remote_ip_org"] == "" and rows["R9"]["remote_ip_full_location"] is None
    assert rows["R14"]["http_status"] is None and rows["R14"]["object_size"] is None
    assert rows["R20"]["partition_key"] == "2025-12-31"


def test_large_dimension_gives_the_same_rows(spark, object_log, ips):
    raw = files.object_log(spark, object_log)
    small = objectlog.build_core_s3_logs(raw, ips).collect()
    hot = objectlog.build_core_s3_logs(raw, ips, hot_keys=1).collect()
    assert sorted(map(str, small)) == sorted(map(str, hot))


def test_usage_log(spark, object_log, ips):
    core = objectlog.build_core_s3_logs(files.object_log(spark, object_log), ips)
    out = objectlog.build_out_s3_logs(core, SITE)
    assert out.columns == REGISTRY["out_s3_logs"].columns
    rows = by(out)
    assert set(rows) == {"R1", "R3", "R6", "R7", "R8", "R9", "R10", "R14", "R20"}
    assert (rows["R6"]["version"], rows["R6"]["table"]) == (None, None)
    assert (rows["R9"]["version"], rows["R9"]["table"]) == (None, "x.parquet")
    assert rows["R10"]["table"] == "core_epacems__hourly_emissions.parquet"
    kinds = {k: r["usage_type"] for k, r in rows.items()}
    assert kinds["R1"] == "other_s3" and kinds["R3"] == "viewer_link"
    assert kinds["R7"] == "viewer_duckdb" and kinds["R8"] == "docs_link"
    assert kinds["R20"] == "all"


def test_sqlite_endings_are_one_format_everywhere(spark, object_log, ips):
    put(f"{object_log}/2026-03-01-00", line("R30", key="stable/db.sqlite.zip"))
    core = objectlog.build_core_s3_logs(files.object_log(spark, object_log, ["2026-03-01"]), ips)
    row = objectlog.build_out_s3_logs(core, SITE).first()
    assert (row["table"], row["key"]) == ("db.sqlite", "stable/db.sqlite")
    assert row["request_uri"] == "GET /stable/db.sqlite HTTP/1.1"


def test_line_with_too_many_fields_fails(spark, tmp_path):
    root = str(tmp_path / "log")
    put(f"{root}/2026-03-01-00", line(region="us-west-2 surplus"))
    with pytest.raises(PySparkException, match="unknown fields"):
        files.object_log(spark, root).collect()


def test_different_rows_under_one_id_fail_the_write(spark, tmp_path, ips):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    put(f"{root}/2026-03-01-00", line() + line(agent='"other"'))
    core = objectlog.build_core_s3_logs(files.object_log(spark, root), ips)
    with pytest.raises(PySparkException, match="different rows share a key"):
        write_table(core, out, "core_s3_logs")
    assert not os.path.exists(f"{out}/core_s3_logs/partition_key=2026-03-01")


def test_days_select_files_by_name(spark, object_log):
    days = files.object_log(spark, object_log, ["2025-12-31", "2026-02-26"])
    assert [r.request_id for r in days.collect()] == ["R20"]
    assert files.object_log(spark, object_log, ["2020-01-01"]).count() == 0
    assert files.object_log(spark, object_log + "/absent").count() == 0


def event(insert_id, event=None, user=None, at="2025-08-31T10:00:00Z", text=None, payload=True, **more):
    record = {
        "insertId": insert_id, "logName": "log", "receiveTimestamp": at, "timestamp": at,
        "labels": {"instanceId": "i"}, "resource": {"type": "t", "labels": {"location": "l"}},
    }
    if text:
        record["textPayload"] = text
    if payload:
        record["jsonPayload"] = {"event": event, "timestamp": at, "userId": user, **more}
    return json.dumps(record) + "\n"


def filters(n):
    return json.dumps([
        {"fieldName": f"f{i}", "fieldType": "number", "operation": "equals", "value": i}
        for i in range(n)
    ])


@pytest.fixture
def viewer_log(tmp_path):
    root = str(tmp_path / "viewer_log")
    params = {"name": "t", "page": 1, "perPage": 100}
    put(f"{root}/2025/08/31/00.json", "".join([
        event("a1", "search", "u1", "2025-08-31T10:00:00Z", query="q", url="/search"),
        event("a2", "hit", "u1", "2025-08-31T10:30:00Z", name="n", score=0.5, tags="x"),  # 30:00
        event("a3", "search", "u1", "2025-08-31T11:00:01Z"),  # 30:01
        event("a4", "search", None, "2025-08-31T11:00:01Z"),
        event("a5", "duckdb_preview", "u2", params={**params, "filters": filters(8)}),
        event("a6", "duckdb_csv", "u2", "2025-08-31T09:00:00.5Z", params={**params, "filters": filters(1)}),
        event("a7", "duckdb_csv", "u2", params={**params, "filters": "[]"}),
        event("a8", "privacy-policy", "u2", accepted=True, newsletter=False),
        event("a9", "privacy-policy", None, accepted=True),
    ]))
    put(f"{root}/2025/08/31/01.json", "".join([
        event("b1", "loading", "u3"),  # unknown event: payload dropped, row without event
        event("b2", "duckdb_preview", "u3", params={"name": "t", "filters": "[]"}),  # no page
        event("b3", text="GET /callback?next=/search?q%3Dgas+plants HTTP/1.1", payload=False),
        event("b4", text="GET /other", payload=False),
        event("b5", "duckdb_preview", "u3", params={**params, "filters": "{bad"}),
        event("b6", "duckdb_preview", "u3", params={**params, "filters": '[{"fieldName": "f"}]'}),
        event("b7", "search", "u3", "no time"),
        '{"insertId": "b8", \n',
    ]))
    put(f"{root}/2025/09/01/00.json", event("c1", "search", "u1", "2025-09-01T00:10:00Z"))
    return root


def test_viewer_events(spark, viewer_log):
    raw = files.viewer_log(spark, viewer_log)
    events = viewer.build_viewer_events(raw)
    rows = by(events, "insert_id")
    assert set(rows) == {f"a{i}" for i in range(1, 10)} | {"b3", "c1"}
    sessions = {k: r["session_id"] for k, r in rows.items()}
    assert sessions["a1"] == sessions["a2"] == "2025-08-31-s1"
    assert sessions["a3"] == "2025-08-31-s2" and sessions["a4"] is None
    assert sessions["a6"] == "2025-08-31-s1" and sessions["a5"] == "2025-08-31-s2"
    assert sessions["c1"] == "2025-09-01-s1"
    assert rows["b3"]["event"] == "log_in"
    assert rows["b3"]["log_in_query"] == "gas plants HTTP/1.1"
    assert rows["a5"]["params_filters_field_name"] == "f0"
    assert rows["a5"]["params_filters_value_6"] == "6"
    assert rows["a6"]["params_filters_value"] == "0"
    assert rows["a6"]["params_filters_field_name_1"] is None


def test_viewer_tables(spark, viewer_log):
    events = viewer.build_viewer_events(files.viewer_log(spark, viewer_log))
    tables = viewer.build_event_tables(events)
    assert {n: df.count() for n, df in tables.items()} == {
        "core_viewer_log_ins": 1, "core_viewer_searches": 4, "core_viewer_hits": 1,
        "core_viewer_previews": 1, "core_viewer_downloads": 2,
        "core_viewer_user_settings_updates": 1,
    }
    for name, df in tables.items():
        assert df.schema.names == REGISTRY[name].columns


def test_viewer_quarantine_and_strict(spark, viewer_log):
    raw = files.viewer_log(spark, viewer_log)
    rules = {json.loads(r["record"]).get("insertId"): r["rules"] for r in viewer.build_quarantine(raw).collect()}
    assert rules["b5"] == "filters" and rules["b6"] == "filters"
    assert "timestamp" in rules["b7"] and None in rules or "b8" in rules
    assert len(rules) == 4
    with pytest.raises(PySparkException, match="record breaks rules"):
        viewer.build_viewer_events(raw, strict=True).collect()


def test_viewer_load_keeps_rejected_records(spark, tmp_path, viewer_log):
    out = str(tmp_path / "out")
    run(Load(spark, str(tmp_path), out, SITE), "viewer")
    raw = files.viewer_log(spark, viewer_log)
    stored = [n for n in REGISTRY if n.startswith("core_viewer_") and n != "core_viewer_quarantine"]
    kept = sum(read_table(spark, out, n).count() for n in stored)
    rejected = read_table(spark, out, "core_viewer_quarantine")
    assert rejected.count() == 4
    # records without a kept event or, for settings, without a user, belong to no table
    assert kept + rejected.count() <= raw.count() and kept == 10
    asked = [r for n in ("previews", "downloads") for r in read_table(spark, out, f"core_viewer_{n}").collect()]
    sizes = {r.insert_id: len(json.loads(r.params_filters)) for r in asked if r.params_filters}
    assert sizes["a5"] >= 7 and sizes["a6"] == 1
    with pytest.raises(ValueError, match="4 records break rules"):
        run(Load(spark, str(tmp_path), str(tmp_path / "strict"), SITE, strict=True), "viewer")


def test_viewer_days(spark, viewer_log):
    raw = files.viewer_log(spark, viewer_log, ["2025-09-01", "2025-09-02"])
    assert [r.insertId for r in raw.collect()] == ["c1"]
    assert files.viewer_log(spark, viewer_log, ["2025-09-02"]).count() == 0


def test_repository_traffic(spark, tmp_path):
    root = str(tmp_path / "github")
    day = {"count": 5, "uniques": 3}
    put(f"{root}/clones/2025-01-06.json", json.dumps({"count": 1, "clones": [
        {"timestamp": "2025-01-05T00:00:00Z", **day}, {"timestamp": "2025-01-06T00:00:00Z", **day},
        {"timestamp": "2025-01-06T00:00:00Z", **day}, {"timestamp": "2025-01-12T00:00:00Z", **day},
        {"timestamp": "2025-01-13T00:00:00Z", **day}]}))
    raw = files.traffic_series(spark, f"{root}/clones", "clones")
    clones = repository.build_series(raw, "core_github_clones")
    assert sorted(str(r.metrics_date) for r in clones.collect()) == ["2025-01-06", "2025-01-12"]
    assert clones.first().partition_key == "2025-01-06" and clones.first().total_clones == 5

    put(f"{root}/popular_paths/2025-01-06.json", json.dumps([
        {"path": "/a", "title": "A", "count": 9, "uniques": 4},
        {"path": "/b", "title": "B", "count": 8, "uniques": 2}]))
    paths = repository.build_popular(
        files.popular(spark, f"{root}/popular_paths", "popular_paths"), "core_github_popular_paths")
    assert sorted((r.path, r.total_views, str(r.metrics_date)) for r in paths.collect()) == [
        ("/a", 9, "2025-01-06"), ("/b", 8, "2025-01-06")]
    put(f"{root}/popular_referrers/2025-01-06.json", json.dumps([
        {"referrer": "x", "count": 1, "uniques": 1}, {"referrer": "x", "count": 2, "uniques": 1}]))
    with pytest.raises(Exception, match="key repeats"):
        repository.build_popular(
            files.popular(spark, f"{root}/popular_referrers", "popular_referrers"),
            "core_github_popular_referrers").collect()


def test_repository_history_reads_newest_file(spark, tmp_path):
    root = str(tmp_path / "github")
    user = {"id": 7, "login": "me", "node_id": "n", "gravatar_id": "", "avatar_url": "u",
            "user_view_type": "public", "site_admin": False, "type": "User"}
    put(f"{root}/stargazers/2025-01-02.json", json.dumps([]))
    put(f"{root}/stargazers/2025-01-01.json",
        json.dumps([{"starred_at": "2024-05-01T10:00:00Z", "user": user}]))
    os.utime(f"{root}/stargazers/2025-01-02.json", (1_000_000, 1_000_000))
    stars = repository.build_stargazers(files.stargazers(spark, f"{root}/stargazers"))
    assert stars.schema.names == REGISTRY["core_github_stargazers"].columns
    assert [(r.id, r.login, str(r.starred_at)) for r in stars.collect()] == [
        (7, "me", "2024-05-01 10:00:00")]

    fork = {"id": 1, "name": "f", "size": 12, "fork": True, "owner": {"login": "o"}, "topics": ["a", "b"],
            "permissions": {"admin": False}, "license": None, "open_issues": 2, "open_issues_count": 2,
            "html_url": "h", "url": "u", "created_at": "2024-01-01T00:00:00Z",
            "updated_at": "2024-01-02T00:00:00Z", "pushed_at": None}
    put(f"{root}/forks/2025-01-01.json", json.dumps([fork]))
    row = repository.build_forks(files.forks(spark, f"{root}/forks")).first()
    assert (row.size_kb, row.owner, row.topics, row.license) == (12, '{"login": "o"}', '["a", "b"]', None)
    assert str(row.created_at) == "2024-01-01 00:00:00" and row.url == "u"


def test_dataset_snapshots_in_three_layouts(spark, tmp_path):
    root = str(tmp_path / "kaggle")
    put(f"{root}/2025-09-14.json", json.dumps({
        "metrics_date": "2025-09-14", "info": {
            "datasetSlugNullable": "set", "hasDatasetSlug": True, "datasetSlug": "set",
            "totalViewsNullable": None, "hasTotalViews": False, "totalViews": 0,
            "totalVotes": 3, "usabilityRatingNullable": 0.9, "hasUsabilityRating": True,
            "keywords": ["a"], "isPrivateNullable": False, "hasIsPrivate": True, "isPrivate": False}}))
    put(f"{root}/2025-10-01.json", json.dumps({
        "metrics_date": "2025-10-01", "datasetSlug": "set", "totalViews": 11, "isPrivate": True,
        "licenses": [{"name": "cc"}]}))
    put(f"{root}/2025-11-23.json", json.dumps({
        "metrics_date": "2025-11-23", "info.datasetSlug": "set", "info.totalViews": 12}))
    out = snapshots.build_core_kaggle_logs(files.dataset_snapshots(spark, root))
    assert out.columns == REGISTRY["core_kaggle_logs"].columns
    rows = by(out, "partition_key")
    assert {r["dataset_name"] for r in rows.values()} == {"set"}
    assert [rows[k]["total_views"] for k in sorted(rows)] == [None, 11, 12]
    assert rows["2025-09-14"]["keywords"] == '["a"]' and rows["2025-09-14"]["total_votes"] == 3
    assert rows["2025-09-14"]["is_private"] == "False" and rows["2025-10-01"]["is_private"] == "True"
    assert rows["2025-10-01"]["licenses"] == '[{"name": "cc"}]'
    put(f"{root}/2025-11-24.json", json.dumps({"hasErrorMessage": True, "errorMessage": "no"}))
    with pytest.raises(Exception, match="snapshot contains an error: no"):
        snapshots.build_core_kaggle_logs(files.dataset_snapshots(spark, root)).collect()


def archive_record(version_id, concept="1", swh=None):
    return {"created": "2025-01-01T00:00:00+00:00", "modified": "2025-01-02T00:00:00+00:00",
            "updated": "2025-01-03T00:00:00+00:00", "id": version_id, "recid": str(version_id),
            "conceptrecid": concept, "title": "t", "submitted": True, "swh": swh,
            "metadata": {"publication_date": "2024-12-31", "version": "v1", "keywords": ["k"]},
            "stats": {"downloads": 4, "version_unique_views": 2}, "links": {"self": "x"}, "files": []}


def test_archive_statistics(spark, tmp_path):
    root = str(tmp_path / "zenodo")
    docs = {"hits": {"hits": [archive_record(10), archive_record(11, "4127026", {"swhid": "old"}),
                              archive_record(12, "1", "new")]}}
    put(f"{root}/2025-01-08-77.json", json.dumps(docs))
    put(f"{root}/2025-01-08-old.json", "not json")
    put(f"{root}/2025-01-08-77.csv", "a,b")
    one = snapshots.build_core_zenodo_logs(files.archive_stats(spark, root, window_days=1), SITE)
    rows = by(one, "version_id")
    assert one.columns == REGISTRY["core_zenodo_logs"].columns and len(rows) == 3
    assert rows[10]["dataset_slug"] == "first_set" and rows[11]["dataset_slug"] == "eia860"
    assert [rows[i]["software_hash_id"] for i in (10, 11, 12)] == [None, "old", "new"]
    assert (rows[10]["dataset_downloads"], rows[10]["version_unique_views"]) == (4, 2)
    assert str(rows[10]["version_publication_date"]) == "2024-12-31" and rows[10]["version"] == "v1"
    week = files.archive_stats(spark, root)
    assert week.select("partition_key").distinct().count() == 7
    assert files.archive_stats(spark, root, ["2025-01-05"]).count() == 3
    assert files.archive_stats(spark, root, ["2025-01-09"]).count() == 0
    put(f"{root}/2025-01-09-78.json", json.dumps({"hits": {"hits": [archive_record(13, "999")]}}))
    with pytest.raises(Exception, match="no mapping for concept_record_id: 999"):
        snapshots.build_core_zenodo_logs(files.archive_stats(spark, root), SITE).collect()


CLIENT_HEADER = ",".join(part.split()[0] for part in files.CLIENT_LOG.split(","))


def client_row(request, agent="Python-urllib/3", operation="storage.objects.get", obj="v1/a/b.parquet"):
    return (f'1657621800000000,1.2.3.4,1,,GET,/x,200,0,1234,99,host,,{agent},{request},{operation},'
            f'bucket,{obj}\n')


def test_client_log_is_appended_once(spark, tmp_path, ips):
    base = str(tmp_path)
    put(f"{base}/client_log/x_usage_2022_07_12", CLIENT_HEADER + "\n" + client_row("r1") +
        client_row("r2", agent="curl") + client_row("r3", operation="storage.objects.list") +
        client_row("r4", obj="v2 /"))
    put(f"{base}/client_log/x_storage_2022_07_12", "other,format\n1,2\n")
    os.utime(f"{base}/client_log/x_usage_2022_07_12", (1657584000, 1657584000))  # 2022-07-12
    ips.drop("isEU").write.parquet(f"{base}/ip_dimension")
    load = Load(spark, base, f"{base}/out")
    assert load_client_log(load, "2022-07-13", "2022-07-14") == 0
    assert load_client_log(load, "2022-07-12", "2022-07-13") == 2
    assert load_client_log(load, "2022-07-12", "2022-07-13") == 0
    rows = by(read_table(spark, f"{base}/out", "intake_logs"), "insert_id")
    assert set(rows) == {"r1", "r4"}
    assert (rows["r1"]["tag"], rows["r1"]["object_path"]) == ("v1", "a/b.parquet")
    assert (rows["r4"]["tag"], rows["r4"]["object_path"]) == ("v2", None)
    assert str(rows["r1"]["timestamp"]) == "2022-07-12 10:30:00"
    assert rows["r1"]["response_bytes"] == 1234 and rows["r1"]["remote_ip_city"] == "Town"


def test_request_log_keeps_first_of_repeated_ids(spark, ips):
    request = {"requestUrl": "https://data.example.org/ferc1/f1_cash_flow?_size=1", "requestMethod": "GET",
               "status": 200, "remoteIp": "1.2.3.4", "responseSize": "12.5"}
    other = {**request, "requestUrl": "https://data.example.org/static/app.css"}
    raw = spark.createDataFrame(
        [("i1", "2022-02-01 00:00:00", json.dumps(request), "1"),
         ("i1", "2022-02-02 00:00:00", json.dumps(other), "2"),
         ("i2", "2022-02-02 00:00:00", json.dumps(other), "3"), ("i3", None, None, "4")],
        "insertId string, timestamp string, httpRequest string, spanId string")
    out = requests.build_datasette_request_logs(raw, ips, SITE, "2022-01-31")
    assert out.columns == REGISTRY["datasette_request_logs"].columns
    (row,) = out.collect()
    assert row.request_url_path == "/ferc1/f1_cash_flow" and row.request_url_query == "_size=1"
    assert row.request_url_netloc == "data.example.org" and row.response_size == 12.5
    assert row.remote_ip_city == "Town" and row.span_id is None and row.partition_key == "2022-01-31"


def test_whole_run(spark, tmp_path, object_log, viewer_log, ips):
    base, out = str(tmp_path), str(tmp_path / "out")
    ips.write.parquet(f"{base}/ip_dimension")
    put(f"{base}/github/views/2026-02-25.json",
        json.dumps({"views": [{"timestamp": "2026-02-25T00:00:00Z", "count": 1, "uniques": 1}]}))
    put(f"{base}/kaggle/2026-02-25.json", json.dumps({"metrics_date": "2026-02-25", "totalViews": 1}))
    load = Load(spark, base, out, SITE, ["2026-02-25", "2026-02-26"])
    done = run(load)
    assert set(done) == set(REGISTRY) - {"intake_logs", "datasette_request_logs"}
    summary = read_table(spark, out, "out_s3_daily_summary_by_table")
    rows = {(str(r.time)[:10], r.table, r.version, r.usage_type): (r.request_count, r.megabytes_sent)
            for r in summary.collect()}
    assert rows[("2019-02-06", "core_a.parquet", "stable", "other_s3")] == (2, 2.0)
    assert rows[("2026-02-26", "core_b.parquet", "viewer-bucket", "docs_link")] == (1, 2.0)
    users = read_table(spark, out, "out_s3_daily_summary_by_user")
    assert users.where("remote_ip = '9.9.9.9'").first().usage_type == "other_s3"
    databases = read_table(spark, out, "out_s3_daily_summary_by_db")
    assert databases.where("database = 'parquet_file'").count() > 0
    # an empty day is a typed, empty partition
    assert os.path.isdir(f"{out}/core_s3_logs/partition_key=2026-02-26")
    assert read_table(spark, out, "core_s3_logs", "2026-02-26", "2026-02-26").count() == 0
    # running again replaces the days and nothing else
    before = read_table(spark, out, "core_s3_logs").count()
    run(Load(spark, base, out, SITE, ["2026-02-25"]), "s3")
    assert read_table(spark, out, "core_s3_logs").count() == before == 13
    with pytest.raises(ValueError, match="not a partition"):
        run(Load(spark, base, out, SITE, ["2020-01-01"]))
