import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from trafficlake.llm import resample
from trafficlake.llm.frames import read, shared_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(rows, targets):
    raw, goal = Counter(), Counter()
    for _, text in rows:
        raw.update(features(text)[1])
    for text in targets:
        goal.update(features(text)[1])
    s_all, t_all = sum(raw.values()) + 10000, sum(goal.values()) + 10000
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * s_all / ((raw[b] + 1) * t_all)))
    out = []
    for key, text in rows:
        words, buckets = features(text)
        weight = sum(map(gain, buckets))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    enough = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], -r[1]))
    drawn = enough[: len(enough) * 5 // 100]
    ranks = {id(r): i for i, r in enumerate(drawn, 1)}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_given_texts_like_brute_force(spark):
    docs, bench = (read(spark, "/root/testdata/sf0.01", n) for n in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = resample.resample(docs.repartition(5), bench)
    assert got(out) == brute(rows, [r.text for r in bench.collect()])
    kept = resample.drawn_documents(docs, out)
    assert kept.columns == docs.columns and kept.count() == out.where("rank is not null").count() > 40


def test_odd_rows_ties_and_repeats(spark):
    draw = random.Random(4)
    text = lambda n: " ".join(draw.choice(["Ab", "cd", "é", "9", "x-y", "日本"]) for _ in range(n))
    rows = [(draw.choice([None, *range(60)]), draw.choice([None, "", text(5), text(25), text(40)])) for _ in range(400)]
    rows += [(7, "one two " * 10)] * 300 + [(8, "b" * 300_000 + " c" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("key", F.lit(1))
    goal = spark.createDataFrame([(None,), ("ab cd é",), ("one two",)], "text string")
    assert got(resample.resample(df.repartition(3), goal)) == brute(rows, [None, "ab cd é", "one two"])
    assert got(resample.resample(df.limit(0), goal.limit(0))) == Counter()
    assert got(resample.resample(df.limit(3), goal.limit(0))) == brute(df.limit(3).select("doc_id", "text").collect(), [])


def test_quickselect_finds_every_k(spark):
    rows = spark.createDataFrame([(5, 1, 9, i) if i < 20 else (i % 3, None, i, i) for i in range(40)], "score long, key long, n_features long, place long")
    want = sorted((tuple(r) for r in rows.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0, -r[2], r[3]))
    for k in (1, 7, 20, 21, 40):
        assert sorted(map(tuple, rows.where(resample.kth(rows, k, shared_folder(spark))).collect())) == sorted(want[:k])
