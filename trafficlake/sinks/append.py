"""Append-only loads that skip rows whose key is stored already."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.operators.columns import conform
from trafficlake.operators.joins import new_by_key
from trafficlake.operators.quality import DataQualityError, require_unique, unique_or_fail
from trafficlake.schemas import PARTITION_KEY, Table, table
from trafficlake.session import Metrics, Staging
from trafficlake.sinks.parquet import table_path

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_keys(target: Table) -> list[str]:
    """What makes a row of a table one: its key, within its partition if it has any."""
    return [*dict.fromkeys([PARTITION_KEY, *target.key])] if target.partitioned else list(target.key)


def new_rows(rows: DataFrame, base: str, to: str | Table, seen: Mapping | None = None) -> DataFrame:
    """Those of the (staged) rows whose key is not stored.

    Only partitions that ``rows`` have are read, and of those only files and row groups whose smallest and largest key, which
    Parquet keeps beside the values, leave room for a key of ``rows``: fresh keys read no stored key. ``seen`` has ``limits_of``
    the rows where the caller has observed them.
    """
    target = table(to) if isinstance(to, str) else to
    spark = rows.sparkSession
    path = table_path(base, target.name)
    if not path_exists(spark, path):
        return rows
    if seen is None:
        seen = rows.agg(*[c.alias(name) for name, c in limits_of(target).items()]).first().asDict()
    stored = spark.read.schema(target.schema).parquet(path)
    if target.partitioned:
        stored = stored.where(F.col(PARTITION_KEY).isin(*seen["days"])) if seen["days"] else stored.where(F.lit(False))
    key = _ranged_key(target)
    if key is not None and seen["low"] is not None:
        stored = stored.where(F.col(key).between(F.lit(seen["low"]), F.lit(seen["high"])) | F.col(key).isNull())
    return new_by_key(rows, stored, stored_keys(target))


def _ranged_key(target: Table) -> str | None:
    return next((k for k in target.key if k != PARTITION_KEY), None)


def limits_of(target: Table) -> dict[str, Column]:
    """What decides which stored keys can be those of some rows: their days, smallest and largest key."""
    key = _ranged_key(target)
    ends = (F.min(key), F.max(key)) if key is not None else (F.lit(None), F.lit(None))
    days = F.collect_set(PARTITION_KEY) if target.partitioned else F.first(F.lit(None))
    return {"days": days, "low": ends[0], "high": ends[1]}


def append_new(df: DataFrame, base: str, to: str | Table) -> int:
    """Append the rows whose key is new to a Parquet table; returns how many.

    The input is evaluated and staged once. The write itself finds what is new, checks its keys and counts it.
    """
    target = table(to) if isinstance(to, str) else to
    with Staging(df.sparkSession) as stage:
        seen, counted = Metrics(**limits_of(target)), Metrics(n=F.count(F.lit(1)))
        rows = stage.keep(seen.watch(conform(df, target)))
        new = new_rows(rows, base, target, {name: seen[name] for name in seen.measures})
        if new.isEmpty():
            log.warning("%s: nothing new, no data written", target.name)
            return 0
        checked = unique_or_fail(new, stored_keys(target), f"{target.name}: key repeats")
        try:
            _write(counted.watch(checked), base, target)
        except PySparkException as e:
            if "key repeats" in str(e):
                raise DataQualityError(str(e)) from e
            raise
        return counted["n"] or 0


def append_staged(rows: DataFrame, base: str, to: str | Table) -> int:
    """Append staged rows that are known to be new and to have a key each; returns how many."""
    target = table(to) if isinstance(to, str) else to
    count = rows.count()
    if count:
        _write(rows, base, target)
    return count


def _write(rows: DataFrame, base: str, target: Table) -> None:
    path = table_path(base, target.name)
    if target.partitioned:
        rows.hint("rebalance", PARTITION_KEY).write.mode("append").partitionBy(PARTITION_KEY).parquet(path)
    else:
        rows.write.mode("append").parquet(path)


def append_new_jdbc(df: DataFrame, to: str | Table, options: dict[str, str]) -> int:
    """The same for a database table; ``options`` are Spark's JDBC options without ``dbtable``.

    Only the key columns are selected in the database.
    """
    target = table(to) if isinstance(to, str) else to
    spark = df.sparkSession
    keys = ", ".join(f'"{k}"' for k in stored_keys(target))
    stored = (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", f'(select {keys} from "{target.name}") stored_keys')
        .load()
    )
    with Staging(spark) as stage:
        rows = stage.keep(new_by_key(conform(df, target), stored, stored_keys(target)))
        count = rows.count()
        if count == 0:
            log.warning("%s: nothing new, no data written", target.name)
            return 0
        require_unique(rows, stored_keys(target), target.name)
        rows.write.format("jdbc").options(**options).option("dbtable", target.name).mode(
            "append"
        ).save()
    return count
