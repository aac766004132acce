"""Whole loads: one source, all daily sources, all full-history sources.

    spark-submit run_load.py --input s3a://logs --output s3a://tables --day 2024-01-05
"""

from __future__ import annotations

import argparse
import importlib
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators.enrich import IP_RECORD, resolve_durably
from trafficlake.operators.quality import DataQualityError, require_balance, require_unique
from trafficlake.operators.summaries import summaries_at_once, usage_cube
from trafficlake.plans import objectlog, report, repository, requests, snapshots, viewer
from trafficlake.schemas import FIRST_PARTITION, PARTITION_KEY, table
from trafficlake.session import Metrics, Staging, tune
from trafficlake.sinks.append import append_new, path_exists
from trafficlake.sinks.parquet import read_table, write_table
from trafficlake.sinks.release import Release, Tables
from trafficlake.site import Site
from trafficlake.sources import files

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Load:
    """Where a load reads and writes, and which days it stands for (None: all history)."""

    spark: SparkSession
    source: str
    target: str
    site: Site = Site()
    days: Sequence[str] | None = None
    window_days: int = 7
    strict: bool = False
    # looks up addresses that the stored dimension does not hold yet (see resolve_durably)
    resolver: Callable[[list[str]], list[dict]] | None = None
    calls_per_second: float | None = None
    # set by ``published``: tables go there and appear together at the end
    release: Release | None = None
    # rows written by table, as the writing jobs counted them
    written: dict[str, int] = field(default_factory=dict)

    def write(self, frames: dict[str, DataFrame]) -> list[str]:
        for name, df in frames.items():
            days = self.days if table(name).partitioned else None
            counted = Metrics(n=F.count(F.lit(1)))
            rows = counted.watch(df)
            if self.release is not None:
                self.release.write(rows, name, days)
            else:
                write_table(rows, self.target, name, days)
            self.written[name] = counted["n"] or 0
            log.info("%s: %s rows", name, self.written[name])
        return list(frames)

    def stored(self, name: str) -> DataFrame:
        """A table as just written, limited to the days of this load."""
        if self.release is not None:
            return self.release.read(name)
        df = read_table(self.spark, self.target, name)
        if self.days is None or not table(name).partitioned:
            return df
        return df.where(df[PARTITION_KEY].isin(*self.days))


def ip_records(load: Load) -> DataFrame:
    """The stored IP dimension, or an empty one."""
    path = f"{load.source}/ip_dimension"
    if path_exists(load.spark, path):
        return load.spark.read.parquet(path)
    return load.spark.createDataFrame([], IP_RECORD)


def grow_ip_dimension(load: Load, logs: DataFrame) -> int:
    """Append records of addresses in ``logs`` that are not stored yet; returns how many."""
    if load.resolver is None:
        return 0
    return resolve_durably(logs, load.resolver, f"{load.source}/ip_dimension", calls_per_second=load.calls_per_second)


def load_object_log(load: Load) -> list[str]:
    """Typed log, usage log from the stored typed log, summaries from the stored usage log.

    Reading back what was written is columnar and pruned, so no step repeats another's
    work; ids are checked while the typed log is written.
    """
    raw = files.object_log(load.spark, f"{load.source}/object_log", load.days)
    grow_ip_dimension(load, objectlog.typed_rows(raw))
    done = load.write({"core_s3_logs": objectlog.build_core_s3_logs(raw, ip_records(load))})
    done += load.write({"out_s3_logs": _usage_input(load)})
    cube = usage_cube(load.stored("out_s3_logs"), PARTITION_KEY)
    with Staging(load.spark) as stage:
        made = stage.keep(summaries_at_once(cube, PARTITION_KEY), "summary")
        return done + load.write(objectlog.build_daily_summaries(made))


def _usage_input(load: Load) -> DataFrame:
    return objectlog.build_out_s3_logs(load.stored("core_s3_logs"), load.site)


def load_viewer(load: Load) -> list[str]:
    """Six event tables and the rejected records of one staged parse.

    Records are parsed and judged once. Events are staged by kind, so each table's write
    reads its own folder. ``strict`` fails the load before anything is written.
    """
    raw = files.viewer_log(load.spark, f"{load.source}/viewer_log", load.days)
    broken = F.size("violations") > 0
    judged = Metrics(
        read=F.count(F.lit(1)), rejected=F.count_if(broken), dropped=F.count_if(~broken & viewer.without_event())
    )
    kept = Metrics(n=F.count(F.lit(1)))
    with Staging(load.spark) as stage:
        records = stage.keep(judged.watch(viewer.judged(raw)))
        rejected = viewer.quarantine_of(records)
        read, bad = judged["read"] or 0, judged["rejected"] or 0
        log.info("viewer log: %s records, %s break rules", read, bad)
        if load.strict and bad:
            raise DataQualityError(f"{bad} records break rules, e.g. {rejected.first().rules}")
        events = stage.keep(kept.watch(viewer.events_of(records)), "event")
        require_unique(events, ["insert_id", PARTITION_KEY], "viewer events")
        done = load.write({"core_viewer_quarantine": rejected, **viewer.build_event_tables(events)})
        require_balance("viewer log", read, {
            "accepted": kept["n"] or 0, "rejected": load.written["core_viewer_quarantine"], "dropped": judged["dropped"] or 0,
        })
        return done


def load_repository(load: Load) -> list[str]:
    spark, root = load.spark, f"{load.source}/github"
    frames = {}
    for metric in ("popular_referrers", "popular_paths"):
        raw = files.popular(spark, f"{root}/{metric}", metric, load.days)
        frames[f"core_github_{metric}"] = repository.build_popular(raw, f"core_github_{metric}")
    for metric in ("clones", "views"):
        raw = files.traffic_series(spark, f"{root}/{metric}", metric, load.days)
        frames[f"core_github_{metric}"] = repository.build_series(
            raw, f"core_github_{metric}", load.window_days
        )
    return load.write(frames)


def load_repository_history(load: Load) -> list[str]:
    spark, root = load.spark, f"{load.source}/github"
    return load.write(
        {
            "core_github_forks": repository.build_forks(files.forks(spark, f"{root}/forks")),
            "core_github_stargazers": repository.build_stargazers(
                files.stargazers(spark, f"{root}/stargazers")
            ),
        }
    )


def load_dataset_snapshots(load: Load) -> list[str]:
    raw = files.dataset_snapshots(load.spark, f"{load.source}/kaggle", load.days)
    return load.write({"core_kaggle_logs": snapshots.build_core_kaggle_logs(raw)})


def load_archive(load: Load) -> list[str]:
    raw = files.archive_stats(load.spark, f"{load.source}/zenodo", load.days, load.window_days)
    return load.write({"core_zenodo_logs": snapshots.build_core_zenodo_logs(raw, load.site)})


def load_client_log(load: Load, start: str, end: str) -> int:
    """Older storage usage log of files written in a time range: append new rows."""
    raw = files.client_log(load.spark, f"{load.source}/client_log", start, end)
    rows = requests.build_intake_logs(raw, ip_records(load), start)
    return append_new(rows, load.target, "intake_logs")


def load_request_log(load: Load, raw: DataFrame, partition: str) -> int:
    """Older API request log (any frame with its columns): append new rows."""
    rows = requests.build_datasette_request_logs(raw, ip_records(load), load.site, partition)
    return append_new(rows, load.target, "datasette_request_logs")


def write_report(load: Load, top: int = 20) -> list[str]:
    """The tables of the analysis report over the stored request log, below ``<target>/report``."""
    logs = load.stored("datasette_request_logs")
    frames = report.build_request_report(logs, top)
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{load.target}/report/{name}")
    return list(frames)


DAILY: dict[str, Callable[[Load], list[str]]] = {
    "s3": load_object_log,
    "kaggle": load_dataset_snapshots,
    "github_partitioned": load_repository,
    "zenodo": load_archive,
    "viewer": load_viewer,
}
FULL_HISTORY: dict[str, Callable[[Load], list[str]]] = {
    "github_nonpartitioned": load_repository_history,
}


def check_days(load: Load) -> None:
    tune(load.spark)
    for day in load.days or ():
        if day < FIRST_PARTITION or day != times.window_days(day, 1)[0]:
            raise ValueError(f"{day} is not a partition (first is {FIRST_PARTITION})")


def run(load: Load, only: str | None = None) -> list[str]:
    """One source by name, or all daily sources followed by all full-history ones."""
    check_days(load)
    sources = {**DAILY, **FULL_HISTORY}
    if only is not None:
        return sources[only](load)
    return [name for source in sources.values() for name in source(load)]


class LoadsFailedError(RuntimeError):
    """Some sources failed; ``done`` has the tables of the others, ``errors`` what each failed with."""

    def __init__(self, done: dict[str, list[str]], errors: dict[str, Exception]):
        self.done, self.errors = done, errors
        super().__init__("; ".join(f"{name}: {e}" for name, e in errors.items()))


def run_together(load: Load, publish: bool = False, at_once: int = 4) -> dict[str, list[str]]:
    """All sources, up to ``at_once`` at the same time, each in a scheduler pool of its own; tables by source.

    With ``spark.scheduler.mode`` FAIR a long source does not hold up the short ones. Sources are independent: one that fails
    leaves the others to finish (with ``publish`` each publishes its own tables), and then fails the whole.
    """
    check_days(load)
    sources = {**DAILY, **FULL_HISTORY}
    context = load.spark.sparkContext

    def one(name: str) -> list[str]:
        context.setLocalProperty("spark.scheduler.pool", name)
        return (published if publish else run)(load, name)

    done: dict[str, list[str]] = {}
    errors: dict[str, Exception] = {}
    with ThreadPoolExecutor(at_once) as threads:
        running = {name: threads.submit(inheritable_thread_target(load.spark)(one), name) for name in sources}
        for name, result in running.items():
            try:
                done[name] = result.result()
            except Exception as e:  # noqa: BLE001
                log.error("%s failed: %s", name, e)
                errors[name] = e
    if errors:
        raise LoadsFailedError(done, errors) from next(iter(errors.values()))
    return done


def published(load: Load, only: str | None = None) -> list[str]:
    """As ``run``, with all tables of the load appearing at once when the last one is written.

    Readers use ``sinks.release.Tables(spark, target).read``; a load that fails leaves them the tables of the last one.
    """
    with Tables(load.spark, load.target).begin() as release:
        return run(replace(load, release=release), only)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder that holds the raw sources")
    parser.add_argument("--output", required=True, help="folder of the tables")
    parser.add_argument("--day", action="append", help="partition to load; repeat for more; none: all")
    parser.add_argument("--only", choices=sorted({**DAILY, **FULL_HISTORY, "client_log": 0, "request_log": 0, "report": 0}))
    parser.add_argument("--site", help="JSON file with site values, at any URI")
    parser.add_argument("--start", help="client_log: first instant of the files' time range")
    parser.add_argument("--end", help="client_log: end of the range, excluded")
    parser.add_argument("--requests", help="request_log: folder of Parquet files with the log's columns")
    parser.add_argument("--partition", help="request_log: partition that its rows get")
    parser.add_argument("--resolver", help="module:function that looks addresses up (object log)")
    parser.add_argument("--window-days", type=int, default=7)
    parser.add_argument("--publish", action="store_true", help="all tables of the load appear at once (sinks/release.py)")
    parser.add_argument("--together", action="store_true", help="independent sources at the same time")
    parser.add_argument("--strict", action="store_true", help="fail on records that break a rule")
    args = parser.parse_args(argv)
    logging.basicConfig(level="INFO")
    spark = SparkSession.builder.appName("trafficlake").getOrCreate()
    site = Site.from_json(args.site, spark) if args.site else Site()
    resolver = None
    if args.resolver:
        module, _, name = args.resolver.partition(":")
        resolver = getattr(importlib.import_module(module), name)
    load = Load(spark, args.input, args.output, site, args.day, args.window_days, args.strict, resolver)
    tune(spark)
    if args.only == "client_log":
        load_client_log(load, args.start, args.end)
    elif args.only == "request_log":
        load_request_log(load, spark.read.parquet(args.requests), args.partition)
    elif args.only == "report":
        write_report(load)
    elif args.together and args.only is None:
        run_together(load, args.publish)
    elif args.publish:
        published(load, args.only)
    else:
        run(load, args.only)


if __name__ == "__main__":
    main()
