import collections
import random

import pytest
from pyspark.sql import functions as F

from trafficlake.llm import rollup
from trafficlake.llm.frames import shared_folder

SCHEMA = "change string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def replay(batches):
    totals = collections.defaultdict(lambda: [0, 0])
    for batch in batches:
        for change, s, g, t, new, old in batch:
            sign = {"insert": (1, new or 0), "delete": (-1, -(new or 0)), "revise": (0, (new or 0) - (old or 0))}.get(change, (0, 0))
            totals[s, g, t][0] += sign[0]
            totals[s, g, t][1] += sign[1]
    return {k: tuple(v) for k, v in totals.items() if any(v)}


def got(table):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in table.totals().collect()}


def test_any_order_any_number_of_commits(spark):
    draw = random.Random(3)
    row = lambda: (draw.choice(["insert", "insert", "delete", "revise", "odd", None]), draw.choice(["a", "b", None]), draw.choice(["en", None]), "v1", draw.choice([None, 5, 7]), draw.choice([None, 2]))
    batches = [[row() for _ in range(30)] for _ in range(5)]
    frames = [spark.createDataFrame(b, SCHEMA).withColumn("batch", F.lit("x")) for b in batches]
    table = rollup.Rollup(spark, shared_folder(spark))
    assert got(table) == {}
    for k in (1, 0, 0, 1, 2):
        table.commit(k, frames[k])
    assert got(table) == replay(batches[:3])
    table.compact(1)
    assert got(table) == replay(batches[:3])
    for k in (4, 2, 3, 4):
        table.commit(k, frames[k])
    assert got(table) == replay(batches)
    table.compact(4)
    table.compact(4)
    assert got(table) == replay(batches)


def test_failed_commit_leaves_totals(spark):
    table = rollup.Rollup(spark, shared_folder(spark))
    good = spark.createDataFrame([("insert", "a", "en", "v1", 3, None)], SCHEMA)
    table.commit(1, good)
    with pytest.raises(Exception, match="lost"):
        table.commit(2, good.withColumn("n_tokens", F.raise_error(F.lit("lost")).cast("long")))
    assert got(table) == {("a", "en", "v1"): (1, 3)}
    table.commit(2, good)
    assert got(table) == {("a", "en", "v1"): (2, 6)}
    table.commit(3, good.limit(0))
    assert got(table) == {("a", "en", "v1"): (2, 6)}


def test_late_batch_beside_a_snapshot(spark):
    """Both orders of commit and compact give the same totals, and a batch that comes again changes nothing."""
    one = lambda n: spark.createDataFrame([("insert", "a", "en", "v1", n, None)], SCHEMA)
    early, late = (rollup.Rollup(spark, shared_folder(spark)) for _ in range(2))
    for table, steps in ((early, (1, 2, 3, None)), (late, (1, 3, None, 2))):
        for step in steps:
            if step is None:
                table.compact(3)
            else:
                assert table.commit(step, one(step))
        assert got(table) == {("a", "en", "v1"): (3, 6)}
        assert not table.commit(3, one(100)) and got(table) == {("a", "en", "v1"): (3, 6)}
    late.compact(3)
    assert not late.commit(2, one(100)) and got(late) == {("a", "en", "v1"): (3, 6)}


def test_failed_recommit_keeps_the_batch(spark, monkeypatch):
    table = rollup.Rollup(spark, shared_folder(spark))
    good = spark.createDataFrame([("insert", "a", "en", "v1", 3, None)] * 40, SCHEMA).repartition(8)
    table.commit(1, good)
    # lost while files are written: some tasks succeed, one does not
    bad = good.withColumn("n_tokens", F.when(F.spark_partition_id() == 5, F.raise_error(F.lit("lost")).cast("long")).otherwise(7))
    with pytest.raises(Exception, match="lost"):
        table.commit(1, bad)
    assert got(table) == {("a", "en", "v1"): (40, 120)}
    # lost between the files and the state
    with monkeypatch.context() as patch, pytest.raises(InterruptedError):
        patch.setattr(table.versions, "put", lambda *_: (_ for _ in ()).throw(InterruptedError()))
        table.commit(1, good.limit(2))
    assert got(table) == {("a", "en", "v1"): (40, 120)}
    # another commit took the number in between
    put, other = table.versions.put, rollup.Rollup(spark, table.path)

    def late(number, state):
        patch.undo()
        other.commit(2, good.limit(1))
        return put(number, state)

    with monkeypatch.context() as patch:
        patch.setattr(table.versions, "put", late)
        table.commit(1, good.limit(2))
    assert got(table) == {("a", "en", "v1"): (3, 9)}
