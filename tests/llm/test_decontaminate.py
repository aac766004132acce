import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trafficlake.llm import decontaminate as dc
from trafficlake.llm.frames import read


def plain_alignment(a, b):
    """Best local alignment by the textbook recurrence."""
    score, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (2 if x == y else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
            best = max(best, score[i][j])
    return best / (2 * len(b))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(2, 6), max_size=25), st.lists(st.integers(2, 6), min_size=1, max_size=12))
def test_alignment_like_textbook(a, b):
    passages, items = np.zeros((2, len(a) + 3), np.uint64), np.ones((2, len(b) + 2), np.uint64)
    passages[0, : len(a)], items[0, : len(b)] = a, b
    items[1, 0] = 9
    got = dc.align(passages, items, np.array([len(b), 1]))
    assert got[0] == plain_alignment(a, b) and got[1] == 0


def frames(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 6)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)]
    docs, want = [], set()
    for d in range(300):
        words = [word() for _ in range(draw.randrange(5, 300))]
        if d % 3 == 0:
            i, passage = d % 20, items[d % 20][1].split()
            for _ in range(draw.randrange(0, 5)):
                k = draw.randrange(len(passage))
                passage[k : k + 1] = draw.choice([[], [word()], [word(), passage[k]]])
            at = draw.randrange(len(words) + 1)
            words[at:at] = [w.upper() + draw.choice(["", ",", "."]) for w in passage]
            want.add((d, i))
        docs.append((d, " ".join(words)))
    return items, docs, want


def test_exact_and_edited_copies(spark):
    items, docs, want = frames(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated(df, bench).collect()}
    assert set(got) == want
    texts, tests = dict(docs), dict(items)
    low = lambda t: "".join(c if c not in ",." else " " for c in t.lower()).split()
    for (d, i), score in list(got.items())[:40]:
        assert score == plain_alignment(low(texts[d]), low(tests[i]))
    assert sorted(r.doc_id for r in dc.clean(df, bench).collect()) == sorted({d for d, _ in docs} - {d for d, _ in want})


def test_strongly_edited_copies_like_full_alignment(spark):
    """15 to 30 in 100 words edited, alone and beside exact copies: as all pairs aligned in full."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(37))) for i in range(32)]
    docs = [(1000 + i, t) for i, t in items[:16]]
    for d, t in items:
        copy = []
        for w in t.split():
            copy += draw.choice([[word()], [word()], [], [w, word()]]) if draw.random() < (0.15, 0.2, 0.25, 0.3)[d % 4] else [w]
        docs.append((d, " ".join([word() for _ in range(20)] + copy + [word() for _ in range(20)])))
    want = {(d, i): s for d, t in docs for i, x in items if (s := plain_alignment(t.split(), x.split())) >= dc.THRESHOLD}
    assert len(want) > 40
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.score for r in got.collect()} == want


def test_common_runs_are_seeds_only_of_items_that_have_few_others(spark):
    """A phrase in every item and every document seeds nothing, but an item made of such phrases is found."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    phrase, other = "this is what all of them say", "and this too is in all"
    items = [(i, f"{' '.join(word() for _ in range(20))} {phrase} {other}") for i in range(dc.COMMON + 10)] + [(500, f"{phrase} {other}")]
    docs = [(d, f"{word()} {phrase} {word()} {other}") for d in range(200)] + [(300, items[3][1]), (301, f"x {phrase} {other} y")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    words = spark.createDataFrame([(i, [int(x) for x in dc.words_of(t).view(np.int64)]) for i, t in items], "uid long, words array<long>")
    kept = {r.uid: r["count"] for r in dc.seeds_of(words).groupBy("uid").count().collect()}
    assert kept[500] == 11 and kept[3] < len(items[3][1].split()) - 10
    want = {(d, i) for d, t in docs for i, x in items if plain_alignment(t.split(), x.split()) >= dc.THRESHOLD}
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(df, bench).collect()} == want
    assert want == {(d, 500) for d, _ in docs} | {(300, 3)}


def test_one_seed_in_a_third_of_all_rows(spark):
    """Hot documents and hot seeds over many partitions, with joins forced to shuffle."""
    item = "one two three four five six"
    rows = [(k % 7, f"{item} " * 2 if k % 3 == 0 else f"word{k} and{k} more{k}") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    bench = spark.createDataFrame([(1, item), (2, "nothing of this kind here")], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = Counter(map(tuple, dc.contaminated(df, bench).collect()))
        left = dc.clean(df, bench).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == Counter((d, 1, 1.0) for d, t in rows if t.startswith("one")) and sum(got.values()) == 300
    assert Counter(map(tuple, left)) == Counter(r for r in rows if not r[1].startswith("one"))


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "one two three four"), (1, "one two three four"), (2, None), (3, ""), (4, "Hi"), (None, "x y z w")], "item_id long, text string")
    rows = [(None, "one two three four"), (1, None), (2, ""), (3, "q " * 300_000 + "x y z w"), (4, "say hi"), (4, "say hi")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("s")).withColumn("item_id", F.lit(0))
    got = sorted(((r.doc_id, r.item_id, r.score) for r in dc.contaminated(df, bench).collect()), key=str)
    assert got == sorted([(None, 1, 1.0), (None, 1, 1.0), (3, None, 1.0), (4, 4, 1.0), (4, 4, 1.0)], key=str)
    assert dc.contaminated(df.limit(0), bench).count() == 0
    assert dc.contaminated(df, bench.limit(0)).count() == 0


def test_whole_items_in_given_texts(spark):
    docs, bench = (read(spark, "/root/testdata/sf0.01", n) for n in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    holds = docs.join(bench.select("item_id", F.col("text").alias("item")), F.expr("contains(text, item)")).select("doc_id", "item_id").collect()
    assert holds and {tuple(r) for r in holds} <= got
    assert len(got) < 3 * len(holds)
