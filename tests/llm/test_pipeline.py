"""The pipeline's stages one after the other against plain versions of each."""

import hashlib
import os
import shutil
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from test_forest import brute as near_duplicates
from test_linedup import brute as line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from trafficlake.llm import decontaminate, quality
from trafficlake.llm.frames import read
from trafficlake.llm.queries import WORD_BPE

SF_DIR = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of documents and after each stage, by doc_id."""
    folder = tmp_path_factory.mktemp("stages")
    docs = read(spark, SF_DIR, "documents")
    out = [({r.doc_id: r for r in docs.collect()}, docs.columns)]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(({r.doc_id: r for r in docs.collect()}, docs.columns))
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    for _, columns in stages[1:-1]:
        assert columns == stages[0][1]
    assert set(stages[-1][1]) > set(stages[0][1])


def test_quality(spark, stages):
    before, after = stages[0][0], stages[1][0]
    model = quality.train(read(spark, SF_DIR, "documents"), read(spark, SF_DIR, "labels"))
    scores = model.scores(np.array([quality.features(r.text) for r in before.values()]))
    assert set(after) == {k for k, s in zip(before, scores, strict=True) if s >= 0.5}
    labels = {r.doc_id: r.quality for r in read(spark, SF_DIR, "labels").collect()}
    good = [k for k, q in labels.items() if q == 1]
    assert sum(k in after for k in good) >= 0.98 * len(good)
    assert sum(k in after for k, q in labels.items() if q == 0) <= 0.15 * (len(labels) - len(good))
    assert all(after[k] == before[k] for k in after)


def test_line_dedup(stages):
    before, after = stages[1][0], stages[2][0]
    want = line_dedup([(k, before[k].text.split("\n")) for k in sorted(before)])
    assert {k: r.text for k, r in after.items()} == {k: "\n".join(v) for k, v in want.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_duplicates(stages):
    before, after = stages[2][0], stages[3][0]
    classes = near_duplicates([(k, r.text) for k, r in before.items()])
    heads = {c for _, _, c in classes}
    assert len(set(after) ^ heads) <= 0.01 * len(heads) and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = stages[3][0], stages[4][0]
    items = [r.text for r in read(spark, SF_DIR, "benchmark").collect()]
    holds = {k for k, r in before.items() if any(x in r.text for x in items)}
    assert holds and not holds & set(after)
    low = [set(zip(*[decontaminate.words_of(x).tolist()[i:] for i in range(5)], strict=False)) for x in items]
    for k in set(before) - set(after):  # what goes shares long runs with an item
        words = decontaminate.words_of(before[k].text).tolist()
        own = set(zip(*[words[i:] for i in range(5)], strict=False))
        assert any(len(own & x) >= 0.3 * len(x) for x in low)


def test_bpe(stages):
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    before, after = stages[4][0], stages[5][0]
    assert set(before) == set(after)
    for r in after.values():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_entry_works_without_the_operators(tmp_path):
    root = tmp_path / "repo"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".*"))
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 70 and set(e.oracle_sql()) == set(n), len(n)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=60)
