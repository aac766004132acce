"""Resampling towards a target distribution: hashed n-gram importance weights, Gumbel scores, distributed quickselect.

Words are runs of digits, lower-case letters and non-ASCII characters after A to Z are lower-cased. A text's features are all
its runs of one to three words, repeats counted, in ``BUCKETS`` buckets by the CRC-32 of the run with single spaces. The gain of
a bucket is its smoothed log-ratio between target texts and documents in thousandths; a document's weight is the sum of
its features' gains. A Gumbel draw from the hash of its key is added, so the highest scores are a sample without
replacement in proportion to ``exp(weight / 1000)``.

Buckets of all texts are counted in tasks and added up by Spark: what reaches the driver is one number a bucket. Scores go
to a narrow table. The k-th best composite key (score, then key, then the row's place) is found by rounds of quickselect:
random rows of the range still open are pivots, one aggregate counts exactly how many rows lie before, on and after
each, and the range shrinks to the gap that holds the k-th. Only winners are sorted, by ranges, and numbered by the
sizes of the ranges before theirs. No key, however often it stands, is gathered in one place: rows of equal key and score
are told apart by their place.

A NULL or empty text has no features, weight 0, and is drawn only if ``least`` is 0. A NULL key counts as the empty text in the
hash and comes last among ties. Rows that repeat a key are documents of their own. An empty target gives every seen bucket
its smoothed gain all the same; an empty table gives an empty result. Texts of any length are read whole. Other
columns of the tables are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, shared_folder

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
LEAST = 20
SEED = 42
PIVOTS = 15  # per round: a range shrinks to about a sixteenth

_letters = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_letters).split()


def buckets_of(words: list[bytes]) -> np.ndarray:
    """The bucket of every run of one to ``LONGEST`` words: each run's CRC carries on that of the run before it."""
    sums = list(map(crc32, words))
    rows, spaced = [np.array(sums, np.int64)], [b" " + w for w in words]
    for n in range(1, LONGEST):
        sums = list(map(crc32, spaced[n:], sums))
        rows.append(np.array(sums, np.int64))
    return np.concatenate(rows) % BUCKETS


def _data(text: pa.StringScalar) -> bytes:
    whole = text.as_buffer()
    return whole.to_pybytes() if whole else b""


def feature_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in the column ``text`` of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                words = words_of(_data(text))
                if words:
                    total += np.bincount(buckets_of(words), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log-ratios in thousandths, rounded down."""
    s_all, t_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)])


def gumbel(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(documents: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score) of each row."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    rows = pick(documents, key=key, text=text).withColumn("h", F.conv(F.substring(named, 1, 8), 16, 10).cast("long"))
    kind = rows.schema["key"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, h in zip(batch["text"], batch["h"].to_pylist(), strict=True):
                words = words_of(_data(text))
                buckets = buckets_of(words)
                weight = int(gain[buckets].sum())
                made.append((len(words), len(buckets), weight, weight + gumbel(h)))
            columns = np.array(made, np.int64).reshape(-1, 4).T
            yield pa.record_batch([batch["key"], *map(pa.array, columns)], ["key", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(weigh, f"key {kind}, n_words long, n_features long, weight long, score long")


# rows sort by this: best score first, then key with NULL last; the rest only tells rows of one key and score apart
PLACE = ("score", "key", "n_features", "place")


def _order() -> Column:
    return F.struct((-F.col("score")).alias("a"), F.col("key").isNull().alias("b"), F.col("key").alias("c"), (-F.col("n_features")).alias("d"), F.col("place").alias("e"))


def kth(rows: DataFrame, k: int, folder: str) -> Column:
    """A condition that holds for the first ``k`` rows in the order of ``PLACE`` (1 <= k <= the number of rows)."""
    at, turn = rows.select(*PLACE), 0
    while True:
        pivots = at.orderBy(F.xxhash64("place", F.lit(turn))).limit(PIVOTS).select(_order().alias("o")).distinct().orderBy("o").collect()
        value = [_literal(r.o, at) for r in pivots]
        before, on = (
            [F.sum(F.when(test(v), 1).otherwise(0)) for v in value]
            for test in (lambda v: _order() < v, lambda v: _order() == v)
        )
        counts = at.agg(F.array(*before).alias("before"), F.array(*on).alias("on")).first()
        low, skipped = None, 0
        for v, before_v, on_v in zip(value, counts.before, counts.on, strict=True):
            if before_v < k <= before_v + on_v:
                return _order() <= v
            if k <= before_v:
                at = at.where(_order() < v)
                break
            low, skipped = v, before_v + on_v
        if low is not None:
            at, k = at.where(_order() > low), k - skipped
        path, turn = f"{folder}/open-{turn}", turn + 1
        at.write.parquet(path)
        at = rows.sparkSession.read.schema(at.schema).parquet(path)


def _literal(order, rows: DataFrame) -> Column:
    kind = rows.schema["key"].dataType
    return F.struct(F.lit(order.a).alias("a"), F.lit(order.b).alias("b"), F.lit(order.c).cast(kind).alias("c"), F.lit(order.d).alias("d"), F.lit(order.e).alias("e"))


def _ranked(winners: DataFrame, folder: str) -> DataFrame:
    """``winners`` with their ``rank`` 1, 2, .. in order: sorted by ranges, each counted on from the ranges before it."""
    spark = winners.sparkSession
    order = [F.col(f"o.{c}") for c in "abcde"]
    ranges = winners.withColumn("o", _order()).repartitionByRange(*order).sortWithinPartitions(*order).drop("o")
    ranges = ranges.withColumn("id", F.monotonically_increasing_id())
    ranges.write.parquet(f"{folder}/sorted")
    part, within = F.shiftrightunsigned("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    kept = spark.read.schema(ranges.schema).parquet(f"{folder}/sorted").withColumn("part", part)
    starts, total = [], 0
    for r in kept.groupBy("part").count().orderBy("part").collect():  # one row a shuffle partition
        starts.append((r.part, total))
        total += r["count"]
    first = spark.createDataFrame(starts, "part long, first long")
    return kept.join(F.broadcast(first), "part").withColumn("rank", F.col("first") + within + 1).drop("part", "first", "id")


def resample(
    documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least: int = LEAST, seed: int = SEED,
) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of each row; ``rank`` is NULL where a row is not drawn.

    Drawn are the best ``percent`` of a hundred, rounded down, of the rows with at least ``least`` words.
    """
    spark, folder = documents.sparkSession, shared_folder(documents.sparkSession)
    gain = gains(feature_counts(pick(documents, text=text)), feature_counts(pick(target, text=target_text)))
    rows = scored(documents, gain, key, text, seed).withColumn("place", F.monotonically_increasing_id())
    rows.write.parquet(f"{folder}/scored")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/scored")
    enough = F.col("n_words") >= least
    k = rows.where(enough).count() * percent // 100
    if k:
        drawn = enough & kth(rows.where(enough), k, folder)
        rest = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
        rows = _ranked(rows.where(drawn), folder).unionByName(rest)
    else:
        rows = rows.withColumn("rank", F.lit(None).cast("long"))
    return rows.drop("place").withColumnRenamed("key", key)


def drawn_documents(documents: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The whole rows of the documents whose key was drawn."""
    keys = pick(ranks.where("rank is not null"), key=key).distinct()
    return documents.join(keys, documents[key].eqNullSafe(keys["key"]), "left_semi")


ORACLE = r"""with recursive bits as (
  select i as b, i as c, 0 as k from range(256) t(i)
  union all
  select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as materialized (select list(c order by b) as t from bits where k = 8),
texts as (select 'd' as side, doc_id as id, text from documents union all select 'b', row_number() over (), text from benchmark),
words as materialized (
  select side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
runs as materialized (
  select side, id, unnest(w) as f from words
  union all select side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words
  union all
  select side, id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words),
coded as materialized (
  select f, xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::bigint),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::bigint)) % 10000 as bucket
  from (select distinct f from runs), crc),
found as materialized (select side, id, bucket, count(*) as n from runs join coded using (f) group by all),
sums as (
  select bucket, coalesce(sum(n) filter (side = 'd'), 0)::double as s, coalesce(sum(n) filter (side = 'b'), 0)::double as t
  from found group by all),
totals as (select coalesce(sum(s), 0) + 10000 as s_all, coalesce(sum(t), 0) + 10000 as t_all from sums),
gain as (select bucket, floor(1000 * ln((t + 1) * s_all / ((s + 1) * t_all)))::bigint as g from sums, totals),
weights as (
  select id, sum(n)::bigint as n_features, sum(n * g)::bigint as weight
  from found join gain using (bucket) where side = 'd' group by all),
scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint
      as score
  from (select id as doc_id, w from words where side = 'd') left join weights on doc_id = weights.id),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () * 5 // 100 as k
  from scored where n_words >= 20)
select doc_id, n_features, weight, score, r as rank from scored left join (from ranked where r <= k) using (doc_id)"""
