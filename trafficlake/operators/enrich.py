"""IP enrichment: distinct addresses first, then a many-to-one join."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import text
from trafficlake.operators import columns as C
from trafficlake.operators.dedup import distinct_values
from trafficlake.operators.joins import many_to_one, new_by_key
from trafficlake.session import Metrics, Staging
from trafficlake.sinks.append import path_exists

# Fields of an IP record that are looked up but not kept.
UNUSED_IP_FIELDS = (
    "country_flag",
    "country_flag_url",
    "country_currency",
    "continent",
    "isEU",
)

IP_RECORD = (
    "ip string, hostname string, anycast boolean, bogon boolean, city string, region string, "
    "country string, loc string, org string, postal string, timezone string, "
    "country_name string, latitude string, longitude string"
)


def ip_dimension(records: DataFrame, prefix: str = "remote_ip") -> DataFrame:
    """IP records as the columns joined to a log.

    Names get the prefix, the organisation is split into AS number and name, and a
    ``city, region, country`` text is added.
    """
    kept = C.drop(records, UNUSED_IP_FIELDS)
    renamed = C.rename_by(kept, lambda c: prefix if c == "ip" else f"{prefix}_{c}")
    org = F.col(f"{prefix}_org")
    return renamed.withColumns(
        {
            f"{prefix}_asn": text.first_word(org),
            f"{prefix}_org": text.after_first_word(org),
            f"{prefix}_full_location": text.full_location(
                F.col(f"{prefix}_city"), F.col(f"{prefix}_region"), F.col(f"{prefix}_country")
            ),
        }
    )


def with_ip_details(
    logs: DataFrame, records: DataFrame, prefix: str = "remote_ip", **join_options
) -> DataFrame:
    """Logs with the details of their address. Addresses without a record keep NULLs."""
    return many_to_one(logs, ip_dimension(records, prefix), [prefix], **join_options)


def resolve_addresses(
    logs: DataFrame,
    lookup: Callable[[list[str]], list[dict]],
    known: DataFrame | None = None,
    column: str = "remote_ip",
) -> DataFrame:
    """IP records of the distinct addresses in ``logs`` that ``known`` does not hold yet.

    ``lookup`` takes a batch of addresses and returns one record (a dict with the fields
    of ``IP_RECORD``) per address. It runs in the tasks, once per distinct address; the
    result is meant to be appended to the stored dimension, which then serves as the cache.
    """
    fields = [part.split()[0] for part in IP_RECORD.split(", ")]
    addresses = distinct_values(logs, column).withColumnRenamed(column, "ip")
    if known is not None:
        addresses = new_by_key(addresses, known, ["ip"])

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = lookup(batch["ip"].tolist())
            yield pd.DataFrame(found, columns=fields, dtype=object)

    return addresses.mapInPandas(resolve, IP_RECORD)


def resolve_durably(
    logs: DataFrame,
    lookup: Callable[[list[str]], list[dict]],
    store: str,
    column: str = "remote_ip",
    call_size: int = 500,
    calls_per_second: float | None = None,
    tries: int = 5,
    pause: float = 1.0,
) -> int:
    """Look up the addresses in ``logs`` that the dimension stored at ``store`` lacks, and add them to it; returns how many.

    For services where each call counts. Addresses go in buckets of about ``call_size`` by their hash. A bucket is one call, made
    by one task, and its answers are stored before the next bucket is asked, at ``calls_per_second`` at most. So a load
    that fails has stored all it was told, and the next one asks only for the rest. A failed call is repeated up to ``tries``
    times, after pauses that double. (A task whose executor is lost between answer and commit asks again.)
    """
    spark = logs.sparkSession
    addresses = distinct_values(logs, column).withColumnRenamed(column, "ip")
    if path_exists(spark, store):
        addresses = new_by_key(addresses, spark.read.schema(IP_RECORD).parquet(store), ["ip"])
    fields = [part.split()[0] for part in IP_RECORD.split(", ")]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = [ip for batch in batches for ip in batch["ip"]]
        for attempt in range(tries) if asked else ():
            try:
                yield pd.DataFrame(lookup(asked), columns=fields, dtype=object)
                return
            except Exception:  # noqa: BLE001
                if attempt + 1 == tries:
                    raise
                time.sleep(pause * 2**attempt)

    added, asked_at = 0, 0.0
    with Staging(spark) as stage:
        wanted = stage.keep(addresses)
        buckets = -(-wanted.count() // call_size)
        if buckets:
            wanted = stage.keep(wanted.withColumn("bucket", F.pmod(F.xxhash64("ip"), F.lit(buckets)).cast("int")), "bucket")
        for k in range(buckets):
            if calls_per_second:
                time.sleep(max(0.0, asked_at + 1 / calls_per_second - time.monotonic()))
            asked_at = time.monotonic()
            part = wanted.where(F.col("bucket") == k).select("ip")
            counted = Metrics(n=F.count(F.lit(1)))
            counted.watch(part.coalesce(1).mapInPandas(ask, IP_RECORD)).write.mode("append").parquet(store)
            added += counted["n"] or 0
    return added
