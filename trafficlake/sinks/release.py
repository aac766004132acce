"""Tables that are published together.

A release writes the tables of a load into folders of their own, ``<table>/release=<id>``, where nobody looks for them yet. When all
are written, one manifest is published that names the folder of every table and day: those of this release, and of the last
one for whatever this one does not replace. Readers take the newest manifest, so they see all tables of a load or none,
and a load that is killed in the middle leaves them what they had.

A load that finds its manifest's number taken merges its days into the newer manifest and tries the next number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trafficlake.operators.columns import conform
from trafficlake.schemas import PARTITION_KEY, Table, table
from trafficlake.sinks.parquet import file_names, table_path

MANIFESTS = "_releases"
WHOLE = ""  # the only part of an unpartitioned table
EMPTY = ""  # a day that was loaded and has no rows


def _resolve(to: str | Table) -> Table:
    return table(to) if isinstance(to, str) else to


class Versions:
    """A state, a JSON value, in one numbered file a version; the newest is the current one.

    A version is written under another name and renamed to its number, which fails if that number is taken: of two
    writers that started from the same state one has to look again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def system(self):
        return self.path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        return sorted(int(name[:-5]) for name in file_names(self.spark, self.folder) if name.endswith(".json"))

    def load(self, number: int):
        text = self.spark.read.text(f"{self.folder}/{number:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def newest(self) -> tuple[int, object]:
        """(number, state); (0, None) if there is none."""
        number = max(self.numbers(), default=0)
        return (number, self.load(number)) if number else (0, None)

    def put(self, number: int, state) -> bool:
        """Make ``state`` the version of this number; False if there is one."""
        system = self.system()
        system.mkdirs(self.path(self.folder))
        draft, target = self.path(f"{self.folder}/.draft-{uuid.uuid4().hex}"), self.path(f"{self.folder}/{number:012d}.json")
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if not system.exists(target) and system.rename(draft, target):
            return True
        system.delete(draft, False)
        return False

    def drop(self, numbers: Sequence[int]) -> None:
        for n in numbers:
            self.system().delete(self.path(f"{self.folder}/{n:012d}.json"), False)


class Manifest:
    """Which folder holds each part (day) of each table."""

    def __init__(self, number: int = 0, parts: dict[str, dict[str, str]] | None = None):
        self.number, self.parts = number, parts or {}

    def with_parts(self, newer: dict[str, dict[str, str]]) -> Manifest:
        names = {*self.parts, *newer}
        return Manifest(self.number + 1, {n: {**self.parts.get(n, {}), **newer.get(n, {})} for n in sorted(names)})


class Tables:
    """Published tables below one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.versions = Versions(spark, f"{self.base}/{MANIFESTS}")

    def newest(self) -> Manifest:
        number, parts = self.versions.newest()
        return Manifest(number, parts)

    def publish(self, parts: dict[str, dict[str, str]]) -> Manifest:
        """Make these parts the current ones, all at once."""
        while True:
            manifest = self.newest().with_parts(parts)
            if self.versions.put(manifest.number, manifest.parts):
                return manifest

    def read(self, to: str | Table, first: str | None = None, last: str | None = None, at: Manifest | None = None) -> DataFrame:
        """A published table, optionally from day ``first`` to ``last``; only the folders of those days are listed."""
        target = _resolve(to)
        if not target.partitioned and (first is not None or last is not None):
            raise ValueError(f"{target.name} is not partitioned")
        parts = (at or self.newest()).parts.get(target.name, {})
        paths = [
            f"{self.base}/{path}"
            for day, path in sorted(parts.items())
            if path != EMPTY and (first is None or day >= first) and (last is None or day <= last)
        ]
        if not paths:
            return self.spark.createDataFrame([], target.schema)
        root = table_path(self.base, target.name)
        df = self.spark.read.schema(target.schema).option("basePath", root).parquet(*paths)
        return df.select(*target.columns)

    def days(self, to: str | Table) -> list[str]:
        """Days of a partitioned table that were loaded, with or without rows."""
        return sorted(self.newest().parts.get(_resolve(to).name, {}))

    def begin(self) -> Release:
        return Release(self)

    def drop_unused(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the ``keep`` newest manifests names, and older manifests; returns the folders.

        Not while a release is being written or an old one read.
        """
        newest, system = self.newest(), self.versions.system()
        numbers = range(max(1, newest.number - keep + 1), newest.number + 1)
        kept = {p for n in numbers for parts in self.versions.load(n).values() for p in parts.values()}
        gone = []
        for name in newest.parts:
            for release in file_names(self.spark, table_path(self.base, name)):
                if not any(p == f"{name}/{release}" or p.startswith(f"{name}/{release}/") for p in kept):
                    gone.append(f"{name}/{release}")
                    system.delete(self.versions.path(f"{self.base}/{name}/{release}"), True)
        self.versions.drop([n for n in self.versions.numbers() if n < min(numbers, default=1)])
        return gone


class Release:
    """Tables being written. ``with tables.begin() as release: ..`` publishes at the end, unless something failed."""

    def __init__(self, tables: Tables):
        self.tables, self.id, self.parts = tables, uuid.uuid4().hex, {}

    def __enter__(self) -> Release:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None and self.parts:
            self.tables.publish(self.parts)

    def write(self, df: DataFrame, to: str | Table, days: Sequence[str] | None = None) -> None:
        """Write a table for this release. ``days`` are those it stands for; without, the days that it has."""
        target, tables = _resolve(to), self.tables
        place = f"{target.name}/release={self.id}"
        rows = conform(df, target)
        if not target.partitioned:
            rows.write.mode("overwrite").parquet(f"{tables.base}/{place}")
            self.parts[target.name] = {WHOLE: place}
            return
        writer = rows.hint("rebalance", PARTITION_KEY).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(PARTITION_KEY).parquet(f"{tables.base}/{place}")
        written = {
            name.split("=", 1)[1]: f"{place}/{name}"
            for name in file_names(tables.spark, f"{tables.base}/{place}")
            if name.startswith(f"{PARTITION_KEY}=")
        }
        self.parts[target.name] = {**dict.fromkeys(days or (), EMPTY), **written}

    def read(self, to: str | Table) -> DataFrame:
        """What this release has written of a table, before it is published."""
        target = _resolve(to)
        return self.tables.read(target, at=Manifest(parts={target.name: self.parts.get(target.name, {})}))
