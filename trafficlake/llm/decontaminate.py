"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Texts are compared as lower-case words without ASCII punctuation. Seeds are three-word runs of the items: those that are rare in
the test set, and all runs of an item that common ones make up to the threshold or more. Where a document holds
a seed, the item's words that occur in the passage around it bound the score; where the bound is high enough, the passage is
aligned with the item: +2 for equal words, -1 for different ones and for gaps. The score is the best local alignment over that of
the whole item with itself; from ``THRESHOLD`` on the document holds the item, word for word, edited or in part. The passage is as
long as any alignment of such a score through the seed. A copy that shares no seed with the item is not found.

All of it is joins: seeds with the documents' runs, the windows so found with the documents' texts, their passages with the
items' words, then alignment in the tasks. Items stay in tables, whatever their number. All that goes to every task is a table of
2^``SLOT_BITS`` flags, from which a task sees that nearly all of its runs are no seeds and need not be shuffled. A frequent seed,
or a frequent document, is cut up by the skew join; the windows of one document are gathered, never those of one item.

Whole texts are read; items of under three words are seeds themselves. NULL and empty
documents or items match nothing. Repeated documents and items each count. An empty table gives an empty result, texts of any length are taken whole, and other columns
are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, shared_folder
from trafficlake.llm.shingles import byte_hashes, runs_of

SEED_WORDS = 3
THRESHOLD = 0.5
COMMON = 50  # items
SLOT_BITS = 24
ROWS_AT_ONCE = 256
ALIGNED_AT_ONCE = 512

PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def words_of(text: str | None) -> np.ndarray:
    return byte_hashes((text or "").lower().encode("utf-8", "surrogatepass").translate(PUNCTUATION))


def align(passages: np.ndarray, items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best local alignment score of each passage row with each item row; 0 pads passages, 1 pads items."""
    n, m = items.shape
    step = np.arange(m, dtype=np.int32)
    score, best = np.zeros((n, m), np.int32), np.zeros(n, np.int32)
    real = step[None, :] < lengths[:, None]
    for word in passages.T:
        pair = np.where((items == word[:, None]) & real, 2, -1)
        diagonal = np.zeros_like(score)
        diagonal[:, 1:] = score[:, :-1]
        top = np.maximum(np.maximum(diagonal + pair, score - 1), 0)
        score = np.maximum.accumulate(top + step, axis=1) - step
        np.maximum(best, score.max(1), out=best)
    return best / (2 * np.maximum(lengths, 1))


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *rows]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _words(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts:
        yield pa.record_batch([batch["id"], _lists([words_of(t.as_py()) for t in batch["text"]])], ["id", "words"])


def _runs(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h", "uid", "offset", "m"]
    for batch in items:
        for uid, words in zip(batch["uid"].to_pylist(), batch["words"], strict=True):
            w = words.values.to_numpy().view(np.uint64)
            h = runs_of(w, SEED_WORDS)
            columns = (h.view(np.int64), np.full(len(h), uid), np.arange(len(h)), np.full(len(h), len(w)))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)


def seeds_of(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(h, uid, offset, m) of the runs of (uid, words) that are looked for.

    Those in at most ``COMMON`` items, and all runs of an item that could reach the threshold by words of common runs alone. What
    documents hold has no part in it, so no number of copies can hide an item.
    """
    runs = items.select("uid", "words").mapInArrow(_runs, "h long, uid long, offset long, m long")
    many = runs.groupBy("h").agg(F.count_distinct("uid").alias("k")).where(F.col("k") > COMMON)
    marked = runs.join(many, "h", "left").withColumn("common", F.col("k").isNotNull())
    last = F.col("offset") + F.least("m", F.lit(SEED_WORDS)) - 1
    words = marked.where("common").select("uid", "m", F.explode(F.sequence("offset", last)).alias("p")).distinct()
    few = words.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m")).where(F.col("n") >= threshold * F.col("m"))
    marked = marked.join(few.select("uid", F.lit(True).alias("few")), "uid", "left")
    return marked.where(~F.col("common") | F.col("few").isNotNull()).select("h", "uid", "offset", "m")


def slots_of(seeds: DataFrame) -> np.ndarray:
    """A table of 2^``SLOT_BITS`` flags, however many seeds there are: which leading bits some seed's hash has."""
    slot = F.shiftrightunsigned("h", 64 - SLOT_BITS) + 1
    maps = seeds.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    table = np.zeros(1 << SLOT_BITS, bool)
    for r in maps.collect():  # 4 KB for each 2^15 slots
        bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        table[(r.k - 1) * len(bits) : r.k * len(bits)] = bits
    return table


def passages_of(words: np.ndarray, windows: list[tuple[int, int, int]], threshold: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(uid, b, passage): the words that any alignment of such a score can use if it starts near window b of an item of m words."""
    for uid, b, m in windows:
        reach = math.ceil(2 * m * max(0.0, 1 - threshold))  # it skips at most so many words of the text
        yield uid, b, words[max(0, b * m - reach) : (b + 2) * m + reach]


def scores_of(passages: list[np.ndarray], items: list[np.ndarray], threshold: float) -> np.ndarray:
    """The score of each passage with its item; 0 where their common words rule the threshold out."""
    out = np.zeros(len(items))
    near = [k for k, (p, w) in enumerate(zip(passages, items, strict=True)) if np.isin(w, p).sum() >= threshold * len(w)]
    for at in range(0, len(near), ALIGNED_AT_ONCE):
        part = near[at : at + ALIGNED_AT_ONCE]
        lengths = np.array([len(items[k]) for k in part])
        wanted = np.ones((len(part), int(lengths.max())), np.uint64)
        texts = np.zeros((len(part), max(len(passages[k]) for k in part)), np.uint64)
        for row, k in enumerate(part):
            wanted[row, : lengths[row]] = items[k]
            texts[row, : len(passages[k])] = passages[k]
        out[part] = align(texts, wanted, lengths)
    return out


def _found(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, threshold: float) -> DataFrame:
    """(key, tag, item, score, copies) of each distinct document (key and hash of its text) and each item that it holds."""
    folder = shared_folder(documents.sparkSession)
    docs = pick(documents, key=key, text=text).select("key", _tag(F.col("text")).alias("tag"), "text")
    kind, item_kind = docs.schema["key"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    items = pick(benchmark, id=item, text=text).mapInArrow(_words, f"id {item_kind}, words array<long>")
    items = _staged(items.where(F.size("words") > 0).withColumn("uid", F.monotonically_increasing_id()), f"{folder}/items")
    seeds = _staged(seeds_of(items, threshold), f"{folder}/seeds")
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(SEED_WORDS))).distinct().collect())
    table = slots_of(seeds)
    shift = np.uint64(64 - SLOT_BITS)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                row, h, at = [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for k, t in enumerate(part["text"]):
                    words = words_of(t.as_py())
                    for size in sizes:
                        if len(words) >= size:
                            runs = runs_of(words, size)
                            seen = np.flatnonzero(table[(runs >> shift).astype(np.int64)])
                            row += [k] * len(seen)
                            h.append(runs[seen])
                            at.append(seen)
                taken = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [part["key"].take(taken), part["tag"].take(taken), pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(at))],
                    ["key", "tag", "h", "at"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                row, made = [], []
                for k, (t, windows) in enumerate(zip(part["text"], part["windows"], strict=True)):
                    listed = [(w["uid"], w["b"], w["m"]) for w in windows.as_py()]
                    for one in passages_of(words_of(t.as_py()), listed, threshold):
                        row.append(k)
                        made.append(one)
                taken = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [part["key"].take(taken), part["tag"].take(taken), pa.array([m[0] for m in made], pa.int64()),
                     pa.array([m[1] for m in made], pa.int64()), _lists([m[2] for m in made])],
                    ["key", "tag", "uid", "b", "passage"],
                )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ALIGNED_AT_ONCE):
                part = batch.slice(first, ALIGNED_AT_ONCE)
                one, other = ([x.values.to_numpy().view(np.uint64) for x in part[c]] for c in ("passage", "words"))
                scores = scores_of(one, other, threshold)
                kept = pa.array(np.flatnonzero(scores >= threshold))
                columns = [part[c].take(kept) for c in ("key", "tag", "uid", "b", "id")]
                yield pa.record_batch([*columns, pa.array(scores).take(kept)], ["key", "tag", "uid", "b", "id", "score"])

    met = docs.mapInArrow(hits, f"key {kind}, tag long, h long, at long").join(seeds, "h")
    window = F.floor((F.col("at") - F.col("offset")) / F.col("m")).alias("b")
    listed = met.select("key", "tag", "uid", window, "m").distinct().groupBy(F.col("key").alias("k"), F.col("tag").alias("t"))
    listed = listed.agg(F.collect_set(F.struct("uid", "b", "m")).alias("windows"))
    asked = docs.join(listed, F.col("key").eqNullSafe(F.col("k")) & (F.col("tag") == F.col("t"))).select("key", "tag", "text", "windows")
    passages = asked.mapInArrow(cut, f"key {kind}, tag long, uid long, b long, passage array<long>")
    pairs = passages.join(items.select("uid", "id", "words"), "uid").mapInArrow(
        score, f"key {kind}, tag long, uid long, b long, id {item_kind}, score double"
    )
    # a document that is there twice has every window twice
    each = pairs.groupBy("key", "tag", "uid", "b").agg(F.first("id").alias("id"), F.max("score").alias("score"), F.count(F.lit(1)).alias("copies"))
    return each.groupBy("key", "tag", "uid").agg(F.first("id").alias("item"), F.max("score").alias("score"), F.max("copies").alias("copies"))


def _tag(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, item, score) of each document and each item that it holds."""
    found = _found(documents, benchmark, key, text, item, threshold)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select(F.col("key").alias(key), F.col("item").alias(item), "score")


def clean(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``documents`` that hold no item."""
    found = _found(documents, benchmark, key, text, item, threshold).select("key", "tag").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(row.alias("row"), F.col(f"`{key}`").alias("k"), _tag(F.col(f"`{text}`")).alias("t"))
    return rows.join(found, F.col("k").eqNullSafe(F.col("key")) & (F.col("t") == F.col("tag")), "left_anti").select("row.*")
