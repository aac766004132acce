import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from trafficlake.llm import pii
from trafficlake.llm.frames import read

KEY = "a key"


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


def run(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    rows = {r.k: r for r in pii.pseudonymise(df, KEY, **options).collect()}
    return [(rows[i].text, rows[i].n_values) for i in range(len(texts))]


VALID = [
    "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "+1 (988) 555-2485", "(212) 555-0100",
    "212-555-0100", "+49 30 1234567", "+1 (152) 055-8590", "8.8.8.8", "255.255.255.0", "123-45-6789", "2024-02-29", "31.12.1999", "12/31/2001",
    "Jo.Ann42@mail8.example.com", "x@y.org",
]
INVALID = ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "666-12-3456", "123-00-6789", "2023-02-29", "1899-12-31", "13/13/2001", "12345", "v2.0.1"]


@pytest.mark.parametrize("restore", [False, True])
def test_formats(spark, restore):
    out = run(spark, [f"see {v}, ok." for v in VALID], restore=restore)
    for value, (text, n) in zip(VALID, out, strict=True):
        new = text.removeprefix("see ").removesuffix(", ok.")
        assert n == 1 and new != value, (value, text)
        if value.count(".") != 3:
            shape = lambda s: re.sub(r"\d", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
            assert shape(new) == shape(value)
        if len(re.sub(r"\D", "", value)) in (15, 16):
            assert luhn(new)
    assert dt.date.fromisoformat(out[12][0].split()[1].strip(","))
    assert [t for t, n in run(spark, INVALID)] == INVALID


def test_round_trip_and_links(spark):
    draw = random.Random(1)
    texts = []
    for _ in range(60):
        parts = [draw.choice([*VALID, *INVALID, "word", "é😀", f"{draw.randrange(256)}.7.0.{draw.randrange(256)}"]) for _ in range(12)]
        texts.append(" ".join(parts))
    once = [t for t, _ in run(spark, texts)]
    assert [t for t, _ in run(spark, once, restore=True)] == texts
    assert once != texts
    texts = ["4337166598464399 12 x", "7 4337166598464399", "4111 1111 1111 1111 12", "4337166598464399 4337166598464399"]
    assert [n for _, n in run(spark, texts)] == [1, 1, 1, 2]
    a, b = run(spark, ["4111111111111111 and +1 (212) 555-0100", "4111-1111-1111-1111 212.555.0100"])
    assert re.sub(r"\D", "", a[0].split()[0]) == re.sub(r"\D", "", b[0].split()[0])
    assert re.sub(r"\D", "", a[0])[-10:] == re.sub(r"\D", "", b[0])[-10:]


def test_bijection_on_a_whole_small_domain(spark):
    a, b = 7, 5
    pairs = spark.range(a * b).select(F.array(F.floor(F.col("id") / b).cast("long"), F.col("id") % b).alias("v"))
    moduli = F.array(F.lit(a).cast("long"), F.lit(b).cast("long"))
    new = pairs.select(pii.feistel(F.col("v"), moduli, KEY, F.lit("t")).alias("n"))
    assert new.distinct().count() == a * b
    days = spark.range(319 * 229).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii.pseudonymise(days, KEY)
    assert out.select("text").distinct().count() == 319 * 229
    assert out.agg(F.max("text")).first()[0] == "2100-01-02"


def test_edge_rows(spark):
    long = "x " * 200_000 + "4111111111111111" + " y" * 200_000
    df = spark.createDataFrame([(1, None), (None, ""), (2, long), (2, long), (3, "no values")], "found0 long, text string").withColumn("N_values", F.lit("x"))
    out = pii.pseudonymise(df, KEY)
    assert set(out.columns) == {"found0", "text", "n_values"}
    rows = out.collect()
    assert sorted(r.n_values for r in rows) == [0, 0, 0, 1, 1]
    assert {len(r.text) for r in rows if r.found0 == 2} == {len(long)}
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0


def test_given_texts(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, KEY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    back = pii.pseudonymise(out.select("doc_id", "text"), KEY, restore=True).select("doc_id", "text")
    assert back.exceptAll(docs).count() == 0
    hit = {r.doc_id: r.text for r in out.where("n_values > 0").collect()}
    assert len(hit) > 20
    for r in docs.collect():
        for value in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b", r.text):
            if not value.isdigit() or luhn(value):
                assert value not in hit[r.doc_id]
