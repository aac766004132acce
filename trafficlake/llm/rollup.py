"""Token counts as rollups that are maintained by deltas.

A batch of changes has one row per change of a document: ``insert`` adds a document and its tokens to the totals of its
(source, language, tokenizer version), ``delete`` takes them away, and ``revise`` adds the difference between the new and
the old count. Changes are signed numbers, so totals are additive: a batch is summed on the map side, in parallel and
in any order, however many rows share one group.

A batch is committed by writing its sums to a folder of its own, new for each attempt, and then publishing a state that names
the folder. A commit that fails, at any point, leaves the totals as they were; repeating a commit replaces the batch. States
are numbered versions, and a commit that finds its number taken starts again from the newer state, so batches may be
committed at the same time and in any order.

``compact`` writes the sum of the batches up to an id as one snapshot. The state lists the ids that the snapshot holds: a batch that
comes late, with a smaller id, is counted beside it, and one that comes again is known and changes nothing.

NULL sources, languages and versions are groups of their own; a NULL count is 0; an unknown or NULL change does nothing.
Groups whose documents and tokens are all gone are left out of the totals. Rows that repeat count as often as they are there, an
empty batch adds nothing, and columns other than those named are not read, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.sinks.release import Versions

GROUP = ("source", "lang", "tokenizer")
SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums by group of changes (change, source, lang, tokenizer, n_tokens, old_tokens)."""
    new, old = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("n_tokens", "old_tokens"))
    kind = F.col("change")
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0)
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(kind == "revise", new - old).otherwise(0)
    return changes.groupBy(*GROUP).agg(
        F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens")
    )


class Rollup:
    """Totals kept under one folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, f"{self.path}/states")

    def _state(self) -> tuple[int, dict]:
        number, state = self.versions.newest()
        return number, state or {"snapshot": None, "held": [], "batches": {}}

    def _write(self, sums: DataFrame) -> str:
        folder = f"sums/{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Publish a batch. Again, it replaces itself; False, and nothing changes, if a snapshot holds it."""
        if batch in self._state()[1]["held"]:
            return False
        folder = self._write(deltas(changes))
        while True:
            number, state = self._state()
            if batch in state["held"]:
                return False
            state["batches"][str(int(batch))] = folder
            if self.versions.put(number + 1, state):
                return True

    def _read(self, folders: list[str | None]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders if f]
        return self.spark.read.schema(SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], SUMS)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) after all committed batches."""
        _, state = self._state()
        return _summed(self._read([state["snapshot"], *state["batches"].values()])).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self, upto: int) -> None:
        """Fold the committed batches up to this id into a snapshot."""
        while True:
            number, state = self._state()
            folded = [b for b in state["batches"] if int(b) <= upto]
            if not folded:
                return
            snapshot = self._write(_summed(self._read([state["snapshot"], *(state["batches"].pop(b) for b in folded)])))
            held = sorted({*state["held"], *map(int, folded)})
            if self.versions.put(number + 1, {"snapshot": snapshot, "held": held, "batches": state["batches"]}):
                return


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
