import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from trafficlake.llm import fim
from trafficlake.llm.frames import read

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(key, text):
    text = text or ""
    units = UNIT.findall(text)
    named = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(named[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return key, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_skip_list_reaches_every_rank():
    draw = random.Random(1)
    for n in (0, 1, 7, 8, 9, 64, 65, 700):
        text = "".join(draw.choice(["ab", "c", " ", "é", "😀", "\n", "1"]) for _ in range(n))
        units, listed = UNIT.findall(text), fim.SkipList(text)
        assert listed.n_units == len(units)
        assert [listed.offset(i) for i in range(len(units) + 1)] == [len("".join(units[:i])) for i in range(len(units) + 1)]
        with pytest.raises(IndexError):
            listed.offset(len(units) + 1)
    assert len(fim.SkipList("a " * 5000).lanes) == 5


def test_outputs_and_digests_like_brute_force(spark):
    odd = ["", None, "<P> x", "a<", "<S", "S>", "<M", "é😀 \n\t", "x" * 300_000 + " y" * 20_000, "a<S<P<M", "\\1 $1"]
    rows = [(i if i % 50 else None, odd[i % len(odd)]) for i in range(600)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N", F.lit("x")).withColumn("guest", F.lit(1))
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "guest", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(brute(*r)) for r in rows)
    back = out.select(F.coalesce("text", F.lit("")).alias("t"), fim.restored(F.col("output"), F.col("form")).alias("r"))
    assert back.where("t is distinct from r").count() == 0
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_given_texts(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in docs.collect():
        *head, output = brute(r.doc_id, r.text)
        want[r.doc_id] = (*head, sha(output), sha(r.text or ""))
    assert {r.doc_id: tuple(r) for r in fim.digests(docs).collect()} == want
    assert {w[2] for w in want.values()} == {"plain", "psm", "spm"}
