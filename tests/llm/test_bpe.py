import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trafficlake.llm import bpe
from trafficlake.llm.queries import WORD_BPE

PATH = public_tokenizers.path(WORD_BPE)
OWN, LIBRARY = bpe.WordBpe(PATH), Tokenizer.from_file(PATH)
CASES = [
    "",
    "  \n",
    "Hello  World's it's 12a ñ\n\tx <|startoftext|>a<|endoftext|> b",
    "İstanbul ΣΑΣ ǅ é ½ ² ३",
    "a\xa0b c\x1cd​e\x85f\x00",
    "don'T 'RE <|STARTOFTEXT|> 😀😀 漢字 кириллица עברית",
    "aaaaaaaaaab" * 300,
    "!" * 1000 + "$%&" * 200,
    "Δ" * 70 + "ﬀ" * 70,
]


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", CASES)
def test_like_the_library(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet="aábcd'st !<|>endoftext1\n", max_size=60))
def test_like_the_library_on_any_text(text):
    same(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="thandresilo", min_size=2, max_size=40))
def test_scan_and_heap_agree(word):
    parts = [*[OWN.inner[b] for b in word.encode()][:-1], OWN.last[word.encode()[-1]]]
    assert OWN._scan(list(parts)) == OWN._heap(list(parts))


def test_frame(spark):
    rows = [(1, "The cat's hat", "x"), (1, "The cat's hat", "x"), (None, None, "y"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Ids string").withColumn("n_tokens", F.lit("old"))
    out = bpe.decode_documents(bpe.encode_documents(df, PATH), PATH)
    assert set(out.columns) == {"doc_id", "text", "ids", "n_tokens", "decoded"}
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert got[None, None].ids == [] and got[2, ""].decoded == ""
    assert got[1, "The cat's hat"].decoded == "the</w> cat</w> 's</w> hat</w>"
    assert out.count() == 4
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0
    both = bpe.code_documents(df, PATH)
    assert both.drop("doc_id", "text").exceptAll(out.select(both.drop("doc_id", "text").columns)).count() == 0
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
