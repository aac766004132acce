import collections
import random

from pyspark.sql import functions as F

from trafficlake.llm import linedup


def brute(docs):
    """(doc, lines) in order of key -> kept lines of each."""
    seen, gone = set(), collections.defaultdict(set)
    for key, lines in docs:
        for i in range(len(lines) - 2):
            window = tuple(x if x.strip(" ") else "" for x in lines[i : i + 3])
            if not any(window):
                continue
            if window in seen:
                gone[key].update((i, i + 1, i + 2))
            seen.add(window)
    return {key: [x for i, x in enumerate(lines) if i not in gone[key]] for key, lines in docs}


def test_like_brute_force(spark):
    draw = random.Random(5)
    docs = [(k, [draw.choice([*"abcd", " ", ""]) for _ in range(draw.randrange(0, 25))] or [""]) for k in range(80)]
    df = spark.createDataFrame([(k, "\n".join(lines)) for k, lines in docs], "doc_id long, text string")
    got = {r.doc_id: r for r in linedup.dedup_lines(df.repartition(5)).collect()}
    for key, kept in brute(docs).items():
        assert got[key].text == "\n".join(kept)
        assert got[key].n_removed == got[key].n_lines - len(kept)


def test_edge_rows(spark):
    text = "x\ny\nz\nown"
    rows = [(None, text, 1), (1, text, 2), (1, text, 2), (2, None, 3), (3, "", 4), (4, "x\ny", 5), (5, "\n\n\n\n", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int").withColumn("N_lines", F.lit(0))
    out = linedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "pos", "n_lines", "n_removed"]
    got = sorted((r.doc_id or 0, r.text, r.pos, r.n_removed) for r in out.collect() if r.text is not None)
    assert got == [(0, text, 1, 0), (1, "", 2, 4), (1, "", 2, 4), (3, "", 4, 0), (4, "x\ny", 5, 0), (5, "\n\n\n\n", 6, 0)]
    assert out.where("text is null").count() == 1
    assert linedup.dedup_lines(df.limit(0)).count() == 0


def test_long_text_and_hot_window(spark):
    many = "\n".join(f"line {i}" for i in range(50_000))
    hot = "a\nb\nc"
    df = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2, many).otherwise(F.concat(F.lit(hot + "\n"), "id")).alias("text")
    )
    got = linedup.dedup_lines(df).groupBy("n_removed").count().collect()
    # of the texts that start alike all lines go but the one that differs
    assert {r.n_removed: r["count"] for r in got} == {0: 2, 50_000: 1, 3: 1997}
    plan = linedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
