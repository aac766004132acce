"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once. The top bits of the hash name one of ``BINS`` bins, and each bin keeps its
smallest hash. An empty bin takes the value of a full one, found by its own fixed series of random bins (optimal
densification), so any two sets borrow alike. Of each value the low ``BITS`` bits are stored, two bins a byte, as hex.
The share of equal bins, freed of the matches that so few bits make by chance, estimates the Jaccard similarity of the
shingle sets with a standard error of about 0.02.

A text without words, NULL included, has the empty fingerprint, alike (1) to itself and unlike (0) all others. Equal
texts have equal fingerprints, on every machine. An empty table gives an empty result, texts of any length are taken whole, and other columns
are not read, whatever their names.

``with_next`` pairs each document with the one that follows by key (then by text hash; after the last comes the first)
in a single shuffle of the texts: the ranges of keys are known beforehand from the keys alone, and the first document
of each range is also sent to the range before. No task sees more than a range, and of it two documents at a time.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick
from trafficlake.llm.shingles import mix, shingle_set

WORDS = 5
BINS = 512
BITS = 4
ROWS_PER_BATCH = 128
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_bins = np.arange(BINS, dtype=np.uint64)


def _probe(bins: np.ndarray, attempt: int) -> np.ndarray:
    """The bin that an empty one asks at this attempt."""
    return (mix(bins + np.uint64(BINS * (attempt + 1))) >> _SHIFT).astype(np.int64)


_probes = [_probe(_bins, attempt) for attempt in range(64)]


def sketch(text: str | None) -> np.ndarray:
    """``BITS`` low bits of each bin as small numbers; empty for a text without words."""
    h = shingle_set(text, WORDS)
    if not len(h):
        return np.empty(0, np.uint8)
    bins = (h >> _SHIFT).astype(np.int64)
    first = np.concatenate(([True], bins[1:] != bins[:-1]))
    values, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], full[bins[first]] = h[first], True
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        asked = _probes[attempt][empty] if attempt < len(_probes) else _probe(empty.astype(np.uint64), attempt)
        hit = full[asked]
        values[empty[hit]] = values[asked[hit]]
        empty = empty[~hit]
        attempt += 1
    return (mix(values) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(bits: np.ndarray) -> str:
    return (bits[::2] << BITS | bits[1::2]).astype(np.uint8).tobytes().hex()


def fingerprint(text: str | None) -> str:
    return packed(sketch(text))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two sketches, corrected for matches by chance."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    chance = 0.5**BITS
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def unpacked(text: str) -> np.ndarray:
    data = np.frombuffer(bytes.fromhex(text), np.uint8)
    return np.stack([data >> BITS, data & ((1 << BITS) - 1)], axis=1).ravel()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every whole text; no shuffle."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)

    @F.arrow_udf("string")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py()) for t in batch], type=pa.string())

    rows = pick(df, key=key, text=text)
    return rows.select(F.col("key").alias(key), make("text").alias("fingerprint"))


def _ranges(keys: DataFrame, n: int) -> list:
    """The first keys of at most ``n`` ranges, ascending; the very first is the smallest key. NULL sorts first."""
    starts = keys.repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("key").alias("first"), F.count(F.when(F.col("key").isNull(), 1)).alias("nulls")
    )
    found = [(r.first_, r.nulls) for r in starts.withColumnRenamed("first", "first_").collect()]
    values = sorted({f for f, nulls in found if f is not None})
    return [None, *values] if any(nulls for _, nulls in found) else values


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id as ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    rows = pick(df, key=key, text=text)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = _ranges(rows.select("key"), n)
    values = [h for h in heads if h is not None]
    nulls = len(heads) - len(values)

    @F.arrow_udf("array<int>")
    def ranges_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Its own range and, for the first key of a range, the range before."""
        first = {h: k for k, h in enumerate(heads)}
        for batch in batches:
            out = []
            for scalar in batch:
                k = scalar.as_py()
                own = 0 if k is None else bisect.bisect_right(values, k) - 1 + nulls
                out.append([own, (first[k] - 1) % len(heads)] if k in first else [own])
            yield pa.array(out, type=pa.list_(pa.int32()))

    dealt = rows.select("key", F.coalesce("text", F.lit("")).alias("text"), F.posexplode(ranges_of("key")).alias("guest", "range"))
    order = ["guest", "key", F.xxhash64("text"), "text"]
    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, keys = None, [], []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            batch = pa.record_batch([pa.concat_arrays(keys), *[pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]], names)
            out.clear()
            keys.clear()
            return batch

        for batch in batches:
            for k in range(batch.num_rows):
                text, guest = batch["text"][k].as_py(), batch["guest"][k].as_py()
                if held is None and guest:
                    return
                mine = sketch(text)
                if held is not None:
                    own_key, own, bits = held
                    changed = edited(own, text)
                    other = sketch(changed) if changed != own else bits
                    sha = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
                    keys.append(own_key)
                    out.append((len(own), sha, packed(bits), packed(other), likeness(bits, other), likeness(bits, mine)))
                    if len(out) >= ROWS_PER_BATCH:
                        yield flush()
                if guest:  # only what follows the last one; more guests are ties that sort behind
                    if out:
                        yield flush()
                    return
                held = batch["key"].slice(k, 1), text, mine

    # one range to a task: at most as many as there are shuffle partitions
    parts = dealt.repartitionById(max(1, len(heads)), F.col("range")).sortWithinPartitions(*order)
    out = parts.select("key", "text", "guest").mapInArrow(pair, schema)
    return out.withColumnRenamed("key", key)
