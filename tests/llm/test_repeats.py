import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trafficlake.llm import repeats
from trafficlake.llm.frames import read

SIZE = repeats.SIZE


def brute(rows):
    """(key, bytes, removed, runs, kept) of rows in the order of documents."""
    seen, out = set(), []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - SIZE + 1):
            string = data[i : i + SIZE]
            if string in seen:
                gone[i : i + SIZE] = True
            seen.add(string)
        runs = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(data) else 0
        out.append((key, len(data), int(gone.sum()), runs, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out


def got(df):
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.collect()), key=repr)


def texts(n=60, seed=5):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randint(2, 9))) for _ in range(4000)]
    prose = lambda k: " ".join(draw.choice(words) for _ in range(k))
    passages = [prose(40) for _ in range(3)] + ["x" * 300, "ab" * 200, "long word " * 60]
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            out.append(prose(60))
        elif kind in (1, 2, 3):
            out.append(prose(draw.randint(0, 9)) + draw.choice(passages) + prose(draw.randint(0, 20)) + draw.choice(passages))
        elif kind == 4:
            copied = list(draw.choice(out[: i // 2 + 1]))
            for _ in range(2):
                if copied:
                    copied[draw.randrange(len(copied))] = "Q"
            out.append("".join(copied))
        else:
            out.append(draw.choice([*out, "", "short", "x" * 99, "x" * 100]))
    return out


def test_columns_like_brute_force():
    draw = random.Random(2)
    gram = "the gram that all contexts share"
    assert len(gram) == repeats.GRAM
    sides = ["".join(draw.choice("ab") for _ in range(68)) for _ in range(3)]
    group, offset, rows = [], [], []
    for g in range(4):
        for _ in range(draw.randint(1, 40)):
            left, right = draw.randint(0, 68), 68
            a, b = draw.choice(sides), draw.choice(sides)
            if draw.random() < 0.3:
                a = a[:-5] + "z" + a[-4:]
            rows.append(((a[68 - left :] if left else "") + gram + b[:right]).encode())
            group.append(g)
            offset.append(left)
    rank = list(range(len(rows)))
    draw.shuffle(rank)
    out = repeats.repeated_strings(np.array(group), np.array(rank), np.array(offset), rows)
    for i, row in enumerate(rows):
        for column in range(repeats.GRAMS):
            start = column - (repeats.GRAMS - 1 - offset[i])
            string = row[start : start + SIZE] if start >= 0 else b""
            earlier = len(string) == SIZE and any(
                group[k] == group[i] and rank[k] < rank[i] and rows[k][(s := column - (repeats.GRAMS - 1 - offset[k])) : s + SIZE] == string
                for k in range(len(rows)) if column - (repeats.GRAMS - 1 - offset[k]) >= 0
            )
            assert out[i, column] == earlier


def test_every_string_has_one_context_and_equal_strings_equal_anchors():
    data = [t.encode() for t in texts(40)]
    whole, ends = np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(t) for t in data])
    h, _, begin, strings, offset = repeats.anchors_of(whole, ends)
    want = [i for b, e in zip([0, *ends[:-1]], ends, strict=True) for i in range(b, e - SIZE + 1)]
    assert [i for b, n in zip(begin, strings, strict=True) for i in range(b, b + n)] == want
    seen = {}
    for k, b, n, a in zip(h, begin, strings, offset, strict=True):
        for i in range(b, b + n):
            assert seen.setdefault(whole[i : i + SIZE].tobytes(), (k, b + a - i)) == (k, b + a - i)
    assert len(h) < len(want) / 4
    alone = repeats.anchors_of(whole, ends, np.unique(h))
    assert sorted(alone[2].tolist()) == want and set(alone[3].tolist()) == {1}


def test_pieces_overlap_by_a_string(monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 1000)
    rows = [t.encode() for t in [*texts(20), "y" * 5000, ""]]
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array([0] * len(rows)), pa.array(rows, pa.binary())], ["doc", "v", "data"])
    covered = set()
    for b in repeats.contexts(iter([batch.slice(3)]), np.empty(0, np.uint64), fold=False):
        for r in b.to_pylist():
            covered |= {(r["doc"], r["start"] + i) for i in range(r["size"])}
    assert covered == {(d, i) for d, t in enumerate(rows) if d >= 3 for i in range(len(t) - SIZE + 1)}


@pytest.mark.parametrize("hot", [repeats.HOT, 1, 200])
def test_documents_like_brute_force(spark, hot):
    rows = list(enumerate(texts(120)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit("x")).withColumn("doc", F.lit(1))
    out = repeats.removed(df.repartition(5), hot=hot)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert got(out) == sorted(brute(rows), key=repr)


def test_odd_rows(spark):
    rows = [(None, "x" * 150), (2, None), (1, ""), (3, "y" * 99), (3, "y" * 99), (4, "é" * 60), (5, "é" * 60), (6, "z" * 3_000_000)]
    same = [(7, "abc " * 40)] * 3
    df = spark.createDataFrame(rows + same, "doc_id long, text string")
    want = brute(rows + [(7, "abc " * 40)]) + [(7, 160, 160, 1, b"")] * 2
    assert got(repeats.removed(df.repartition(4))) == sorted(want, key=repr)
    assert repeats.removed(df.limit(0)).count() == 0
    # different texts under one key are documents of their own, one after the other
    two = [(1, "pqr " * 50), (1, "pqr " * 30), (0, "s" * 10)]
    out = got(repeats.removed(spark.createDataFrame(two, "doc_id long, text string")))
    assert out in [sorted(brute([two[2], *order]), key=repr) for order in (two[:2], two[1::-1])]


def test_given_texts(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    want = {k: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for k, n, gone, runs, kept in brute(sorted(map(tuple, docs.collect())))}
    out = repeats.removed(docs.repartition(3))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect()} == want
    assert sum(w[1] for w in want.values()) > 0
