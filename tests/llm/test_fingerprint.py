import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlake.llm import fingerprint as fp
from trafficlake.llm.frames import read
from trafficlake.llm.shingles import shingle_set


def jaccard(a, b):
    a, b = set(shingle_set(a).tolist()), set(shingle_set(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for i, (key, text) in enumerate(rows):
        own, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + after[:half]
        out[key] = (len(own), hashlib.sha256(changed.encode()).hexdigest(), fp.fingerprint(own), fp.fingerprint(changed),
                    jaccard(own, changed), jaccard(own, after))
    return out


def test_given_texts_like_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r for r in fp.with_next(docs.repartition(7)).collect()}
    assert set(got) == set(want)
    errors = []
    for key, (n, sha, own, other, near_edited, near_next) in want.items():
        r = got[key]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, own, other)
        errors += [r.near_edited - near_edited, r.near_next - near_next]
        assert r.near_edited == pytest.approx(fp.likeness(fp.unpacked(own), fp.unpacked(other)))
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.13
    plain = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert plain == {k: v[2] for k, v in want.items()}


def test_unbiased_on_short_and_long_sets():
    draw = random.Random(2)
    for size in (12, 200, 3000):
        errors = []
        for _ in range(40):
            words = [str(draw.random()) for _ in range(size)]
            other = words[: size // 2] + [str(draw.random()) for _ in range(size - size // 2)]
            a, b = " ".join(words), " ".join(other)
            errors.append(fp.likeness(fp.sketch(a), fp.sketch(b)) - jaccard(a, b))
        assert abs(np.mean(errors)) < 0.04


def test_edge_rows(spark):
    rows = [(None, "a b c d e f g"), (5, None), (1, ""), (2, "é😀" * 5000), (9, "one two three four five six seven")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit("x")).withColumn("guest", F.lit(1))
    got = {r.doc_id: r for r in fp.with_next(df).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for k, r in got.items():
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == want[k][:3]
    assert got[5].fingerprint == "" and got[5].near_edited == 1.0
    one = fp.with_next(df.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fp.with_next(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "a b c d e f")] * 3 + [(2, "g h i j k l"), (2, "m n o p q r")]
    got = fp.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got}) == 3
    assert sorted(r.near_next for r in got if r.doc_id == 1) == [0.0, 1.0, 1.0]
