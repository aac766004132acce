import collections
import random

import numpy as np
from pyspark.sql import functions as F

from trafficlake.llm import forest
from trafficlake.llm.components import components
from trafficlake.llm.frames import read
from trafficlake.llm.shingles import runs_of, shingle_set, word_hashes


def shingles(text):
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Links and classes of (key, text) rows by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s or {None}:
            by[x].append(i)
    common = collections.Counter((a, b) for v in by.values() for a in v for b in v if a < b)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for (a, b), n in common.items():
        if not sets[a] or n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {(key, links[i], least[find(i)]) for i, (key, _) in enumerate(rows)}


def test_real_texts_like_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    got = {(r.doc_id, r.n_links, r.class_id) for r in forest.classes(docs).collect()}
    want = brute([tuple(r) for r in docs.collect()])
    assert len(want) == len(got)
    links = lambda rows: sum(n for _, n, _ in rows)
    assert links(want) * 0.99 <= links(got) <= links(want)
    assert len(want - got) <= 0.01 * len(want)
    kept = forest.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in got}


def test_hot_group_of_near_copies(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(700):
        words = list(base)
        for _ in range(draw.randrange(0, 3)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"y{draw.randrange(9999)}" for _ in range(40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {(r.doc_id, r.n_links, r.class_id) for r in forest.classes(df).collect()}
    assert got == brute(rows)


def test_edge_rows(spark):
    long = "word%d " * 3
    rows = [
        (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "other"), (2, None), (3, ""), (4, " \n"),
        (5, "other"), (6, " ".join(str(i) for i in range(150_000))), (7, long), (None, "lonely"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tid", F.lit(1)).withColumn("root", F.lit(2))
    out = forest.classes(df)
    assert sorted(out.columns) == ["class_id", "doc_id", "n_copies", "n_links", "root", "tid"]
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in out.collect())
    assert got == collections.Counter(
        [(None, 1, 2), (1, 1, 2), (1, 1, 2), (1, 1, 1), (5, 1, 1), (2, 2, 2), (3, 2, 2), (4, 2, 2), (6, 6, 0), (7, 7, 0), (None, None, 0)]
    )
    kept = forest.keep_one(df)
    assert kept.columns == df.columns
    left = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    # a NULL key sorts first, so it stands for its class
    assert left == collections.Counter({(None, "a b c d e f"): 1, (1, "other"): 1, (2, None): 1, (6, rows[8][1]): 1, (7, long): 1, (None, "lonely"): 1})
    assert forest.classes(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (200, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100, 200: 200}


def test_hashes():
    assert len(word_hashes(None)) == len(runs_of(word_hashes(" \n"), 5)) == 0
    a, b = word_hashes("thé cat\tsat"), word_hashes("x thé  sat\ncat")
    assert a[0] == b[1] and a[1] == b[3] and a[2] == b[2] and len(set(b.tolist())) == 4
    assert len(shingle_set("a b c")) == 1 and len(shingle_set("a b c d e f")) == 2
    text = "ab " * 800_000
    assert len(word_hashes(text)) == 800_000 and len(np.unique(word_hashes(text))) == 1
