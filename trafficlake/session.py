"""Session settings every job of this package relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime settings, safe to apply to a session somebody else started.
RUNTIME_SETTINGS = {
    # all log times are UTC; timestamps are written without a zone
    "spark.sql.session.timeZone": "UTC",
    # a re-run replaces only the days it produces
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # shuffle sizes, join sides and hot partitions are re-planned from real sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # join without sorting where each build partition turns out to be this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark``; cluster sizing is left as it is."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", app: str = "trafficlake", **extra: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the one it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


class Metrics:
    """What a job counts about the rows that pass one point of it, without a pass of its own.

        counted = Metrics(n=F.count(F.lit(1)))
        counted.watch(df).write.parquet(path)
        counted["n"]
    """

    def __init__(self, **measures: Column):
        self.measures, self.observation = measures, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *[c.alias(name) for name, c in self.measures.items()])

    def __getitem__(self, name: str):
        """A measure of the first job that ran; None if the rows were known to be none and so never looked at."""
        try:
            return self.observation.get[name]
        except Py4JJavaError:  # such a plan is optimised to one without the observed node
            return None


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared checkpoint folder, or None on a cluster that names none.

    ``spark.checkpoint.dir`` is read from the session. Only a local session (tests,
    bench) that leaves it unset gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="trafficlake-")
        atexit.register(shutil.rmtree, folder, True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Staging:
    """Frames kept as Parquet in the shared checkpoint folder while a load needs them.

    A staged frame survives the loss of executors, has its lineage cut, and is columnar:
    a key check reads the key columns only. A cluster that names no shared folder is an error.

        with Staging(spark) as stage:
            rows = stage.keep(rows)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def keep(self, df: DataFrame, *by: str) -> DataFrame:
        """``df`` read back from the staged files, in folders of the columns ``by`` if any."""
        folder = checkpoint_folder(self.spark)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
        self.paths.append(path)
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
