"""Wall time of every bound query: noop sink, median of several runs on a warm session.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 1, after a warm-up run), BENCH_ONLY (comma-separated query names). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trafficlake.queries import all_queries  # noqa: E402
from trafficlake.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = {n for n in os.environ.get("BENCH_ONLY", "").split(",") if n}
    spark = local_session(cpus, "trafficlake-bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def once(query) -> float:
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        once(query)
        times[name] = round(statistics.median(once(query) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median wall time of all queries, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
