"""Small frame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, key="doc_id")``: only these columns, renamed, so no other column of ``df`` can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def with_results(df: DataFrame, **results: Column) -> DataFrame:
    """``df`` plus results. A column of ``df`` that has a result's name, in any case, gives way."""
    taken = {name.lower() for name in results}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(name) for name, c in results.items()])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it.

    An expression of the outer row that stands inside a lambda is worked out again for every element; a lambda's
    variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that the cluster shares (``spark.checkpoint.dir``), gone when the driver ends.

    Only a local session without that setting gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = os.path.join(tempfile.gettempdir(), "trafficlake-llm")
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
