"""The analysis report and the export clean-up on small frames."""

import json

from trafficlake.operators.columns import conform
from trafficlake.plans.export import clean_export, write_json_lines
from trafficlake.plans.report import build_request_report

ROWS = [
    ("a", "2022-01-31 10:00:00", 2e9, "/ferc1", "Some University", "Town", "R", "US", "x"),
    ("b", "2022-02-07 00:00:00", 1e9, "/ferc1", "Cable Co", "Town", "R", "US", None),
    ("c", "2022-02-20 23:59:59", 5e8, "/eia", "Cable Co", "Town", None, "US", None),
    ("d", "2022-04-01 00:00:00", 0.0, None, None, None, None, None, "y"),
]
COLUMNS = (
    "insert_id string, timestamp string, response_size double, request_url_path string, "
    "remote_ip_org string, remote_ip_city string, remote_ip_region string, "
    "remote_ip_country string, referer string"
)


def test_request_report(spark):
    logs = conform(spark.createDataFrame(ROWS, COLUMNS), "datasette_request_logs")
    report = {k: df.collect() for k, df in build_request_report(logs, 1).items()}
    months = {str(r.period): r.gigabytes for r in report["monthly_egress"]}
    assert months == {"2022-01-31": 2.0, "2022-02-28": 1.5, "2022-03-31": 0.0, "2022-04-30": 0.0}
    weeks = {str(r.period): r.requests for r in report["weekly_requests"]}
    assert len(weeks) == 9 and weeks["2022-02-06"] == 1 and weeks["2022-02-27"] == 0
    megabytes = {str(r.period): r.megabytes for r in report["weekly_egress"]}
    assert megabytes["2022-02-13"] == 1000.0
    assert [(r.request_url_path, r.n, round(r.share, 3)) for r in report["top_paths"]] == [("/ferc1", 2, 0.667)]
    assert round(report["top_paths_share"][0].covered, 3) == 0.667
    assert [(r.remote_ip_org, r.n) for r in report["top_organisations"]] == [("Cable Co", 2), ("Some University", 1)]
    assert [r.remote_ip_org for r in report["academic_organisations"]] == ["Some University"]
    assert [(r.full_location, r.n) for r in report["top_cities"]] == [("Town, R, US", 2)]
    assert {r.is_null: r.n for r in report["referer_known"]} == {True: 2, False: 2}
    assert [r.referer for r in report["top_referers"]] == ["x", "y"]
    assert report["largest_response"][0].insert_id == "a"
    profile = {r.column: (r.n_nulls, r.all_null) for r in report["columns"]}
    assert profile["referer"] == (2, False) and profile["trace"] == (4, True)


def test_export_cleanup(spark, tmp_path):
    record = {"protoPayload": {
        "@type": "t", "serviceData": {"a": 1}, "method": "get",
        "requestMetadata": {"ip": "1", "destinationAttributes": {"x": 1},
                            "requestAttributes": {"time": "t", "auth": {"y": 1}}},
        "authorizationInfo": [{"granted": True, "resourceAttributes": {"z": 1}}]}, "id": "1"}
    source = tmp_path / "export.json"
    source.write_text(json.dumps([record, record]))
    raw = spark.read.option("multiLine", True).json(str(source))
    write_json_lines(clean_export(raw), str(tmp_path / "out"))
    lines = spark.read.text(str(tmp_path / "out")).collect()
    assert [json.loads(r.value) for r in lines] == 2 * [{
        "id": "1", "protopayload_auditlog": {
            "method": "get", "requestMetadata": {"ip": "1", "requestAttributes": {"time": "t"}},
            "authorizationInfo": [{"granted": True}]}}]
    plain = spark.read.json(str(tmp_path / "out"))
    assert clean_export(plain.withColumnRenamed("protopayload_auditlog", "protoPayload")).schema == plain.schema
