"""Analysis report over stored request logs: egress, volume, top paths, users, referers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import numbers, text
from trafficlake.operators import reports

# Words that mark academic organisations.
ACADEMIC_WORDS = ("Universitaet", "University", "College", "Institute")


def build_request_report(logs: DataFrame, top: int = 20) -> dict[str, DataFrame]:
    """The report's tables by name. Each reads only the columns it needs."""
    size = F.sum("response_size")
    place = text.full_location(
        F.col("remote_ip_city"), F.col("remote_ip_region"), F.col("remote_ip_country")
    )
    cities = logs.select(place.alias("full_location"))
    monthly = reports.resample_monthly(logs, "timestamp", size.alias("bytes"))
    weekly = reports.resample_weekly(
        logs, "timestamp", size.alias("bytes"), F.count("insert_id").alias("requests")
    )
    paths = reports.top_shares(logs, "request_url_path", top)
    return {
        "monthly_egress": monthly.select("period", numbers.gigabytes(F.col("bytes")).alias("gigabytes")),
        "weekly_egress": weekly.select("period", numbers.megabytes(F.col("bytes")).alias("megabytes")),
        "weekly_requests": weekly.select("period", "requests"),
        "top_paths": paths,
        "top_paths_share": reports.covered_share(paths),
        "top_organisations": reports.value_counts(logs, "remote_ip_org", 10),
        "academic_organisations": reports.value_counts(
            reports.matching(logs, "remote_ip_org", ACADEMIC_WORDS), "remote_ip_org"
        ),
        "top_cities": reports.value_counts(cities, "full_location", top),
        "countries": reports.value_counts(logs, "remote_ip_country_name"),
        "regions": reports.value_counts(logs, "remote_ip_region"),
        "referer_known": reports.null_split(logs, "referer"),
        "top_referers": reports.value_counts(logs, "referer", 5),
        "largest_response": reports.argmax_row(logs, "response_size", F.col("insert_id")),
        "columns": reports.null_profile(logs),
    }
