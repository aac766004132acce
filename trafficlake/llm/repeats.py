"""Removal of repeated 100-byte strings by a column-wise construction over many texts at once.

Every byte covered by a string of ``SIZE`` bytes that also starts earlier (in a smaller document, or further left in the same one) is
removed. Strings are judged on the input and never cross documents.

1. *Anchors.* A string's anchor is the leftmost of its ``GRAM``-byte substrings with the smallest hash, so equal strings have
   equal anchors at equal offsets. The strings of one anchor make one context of at most ``2 * SIZE - GRAM`` bytes. A text gives one
   anchor in about 35 bytes, and (hash of anchor, hash of context, place) is all that is shuffled of it.
2. *Equal contexts.* Of equal contexts all but the first are removed whole. A context that is alone with its anchor has no
   repeats. What is left are first contexts with equal anchors but other bytes around them.
3. *Column-wise construction.* The contexts of an anchor are aligned at it, and one symbol of each is inserted a round, from right to
   left. The sorted order of the suffixes that start in a column is a stable partition of the order of the column to its
   right by the symbol inserted, which is that column of the Burrows-Wheeler transform of the collection; the common prefixes of neighbours
   follow from the minimum over what lay between them. A round reads order, transform and prefixes once in sequence
   and writes the next ones. Strings whose suffixes have ``SIZE`` bytes in common are equal: all but the first are removed.
   Only the newest column is kept, because strings of one anchor stand in one column.
4. *Removal.* The spans of a document are merged and cut out of its bytes.

An anchor that stands in very many contexts (estimated on one document in ``SAMPLED``; the estimate steers work, not results) is
replaced by the strings themselves, each one a context of its own, so no task gets an unbounded group. Equal contexts
within a stretch of ``STRETCH`` bytes of input are folded before anything is shuffled, so one context, however frequent, sends
at most one row a stretch.

Equality of contexts, and of strings of frequent anchors, is that of two 64-bit hashes. A NULL text is empty; texts under
``SIZE`` bytes are left alone. NULL keys count as the smallest number. Rows of one key are ordered by a hash of their text; of rows with
equal key and text all but one are repeats from end to end. Texts of any length are read whole, an empty table
gives an empty result, and other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, shared_folder
from trafficlake.llm.shingles import mix

SIZE = 100
GRAM = 32
GRAMS = SIZE - GRAM + 1  # grams of a string
STRETCH = 1 << 20
SAMPLED = 64
HOT = 200_000  # contexts of one anchor
BLOCK = 20_000  # contexts inserted together, but for larger groups
NONE = 256  # the symbol outside a context

SMALLEST = -(1 << 63)
ANCHORS = "h long, c long, doc long, v long, start long, size long, a long"
SPANS = "doc long, v long, begin long, end long"


def _powers(multiplier: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (multiplier, pow(multiplier, -1, 1 << 64)):
        row = np.full(STRETCH + SIZE, base, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row))
    return out[0], out[1]


class Hashes:
    """Polynomial hashes of any substring of a stretch in constant time."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, multiplier: int):
        if multiplier not in self.tables:
            self.tables[multiplier] = _powers(multiplier)
        power, self.inverse = self.tables[multiplier]
        value = (data.astype(np.uint64) + np.uint64(1)) * power[: len(data)]
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[begin]) * self.inverse[begin])

    def all_of(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        return mix((self.total[size:] - self.total[:n]) * self.inverse[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, from prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])


def anchors_of(data: np.ndarray, bounds: np.ndarray, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(h, c, begin, strings, offset of the anchor) of each context of a stretch of concatenated texts.

    ``bounds`` are the ends of texts in it; strings that cross one do not count. Anchors in ``hot`` give one context a string.
    """
    n = len(data) - SIZE + 1
    if n <= 0:
        return tuple(np.empty(0, np.uint64 if k < 2 else np.int64) for k in range(5))
    first, second = Hashes(data, 0x9E3779B97F4A7C15), Hashes(data, 0xD1342543DE82EF95)
    grams = first.all_of(GRAM)
    bits = np.uint64((STRETCH + SIZE).bit_length())
    low = np.uint64((1 << int(bits)) - 1)
    least = sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), GRAMS)
    anchor = (least & low).astype(np.int64)
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, np.maximum(bounds - SIZE + 1, 0), 1)
    np.add.at(edges, bounds, -1)
    whole = np.cumsum(edges)[:n] == 0
    turn = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]), [True]))
    at = np.flatnonzero(turn)
    begin, end = at[:-1], at[1:]
    real = whole[begin]
    begin, end = begin[real], end[real]
    strings, offset = end - begin, anchor[begin] - begin
    h = grams[anchor[begin]]
    shape = (strings * 256 + offset).astype(np.uint64)
    c = mix(second.of(begin, end + SIZE - 1) + shape)
    if hot is not None and len(hot):
        often = np.isin(h, hot)
        if often.any():
            single = np.flatnonzero(np.repeat(often, strings))
            place = np.repeat(begin - np.concatenate(([0], np.cumsum(strings)[:-1])), strings)[single] + single
            rows = np.ones(len(place), np.int64), np.zeros(len(place), np.int64)
            h = np.concatenate((h[~often], mix(first.of(place, place + SIZE))))
            c = np.concatenate((c[~often], second.of(place, place + SIZE)))
            begin, strings, offset = (np.concatenate((x[~often], y)) for x, y in zip((begin, strings, offset), (place, *rows), strict=True))
    return h, c, begin, strings, offset


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, ends of texts in them, ends of all texts of the batch, where the bytes begin) of pieces that overlap by a string less a byte."""
    data = batch["data"]
    sizes = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    body = data.buffers()[2]
    whole = np.frombuffer(body, np.uint8)[sizes[0] : sizes[-1]] if body else np.empty(0, np.uint8)
    ends = sizes[1:] - sizes[0]
    for begin in range(0, len(whole), STRETCH):
        part = whole[begin : begin + STRETCH + SIZE - 1]
        inner = ends[np.searchsorted(ends, begin, "right") : np.searchsorted(ends, begin + len(part), "right")] - begin
        yield part, inner, ends, begin


def contexts(batches: Iterator[pa.RecordBatch], hot: np.ndarray, fold: bool = True) -> Iterator[pa.RecordBatch]:
    """A row of ``ANCHORS`` for each context of texts (doc, v, data). ``a`` is -1 for a span that is known to be repeated."""
    for batch in batches:
        docs, versions = batch["doc"].to_numpy(), batch["v"].to_numpy()
        for data, bounds, ends, base in stretches(batch):
            h, c, begin, strings, offset = anchors_of(data, bounds, hot)
            row = np.searchsorted(ends, begin + base, "right")
            start = begin + base - np.concatenate(([0], ends))[row]
            doc, v = docs[row], versions[row]
            if fold and len(h):
                order = np.lexsort((start, v, doc, c, h))
                h, c, doc, v, start, strings, offset = (x[order] for x in (h, c, doc, v, start, strings, offset))
                again = np.concatenate(([False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])))
                lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(h))))
                moved = again & ((doc != doc[lead]) | (v != v[lead]) | (start != start[lead]))
                spans = merged(doc[moved], v[moved], start[moved], start[moved] + strings[moved] + SIZE - 1)
                h, c, doc, v, start, strings, offset = (x[~again] for x in (h, c, doc, v, start, strings, offset))
                free = mix(np.arange(len(spans[0]), dtype=np.uint64) + mix(spans[0].view(np.uint64)) + spans[2].astype(np.uint64))
                h, c = np.concatenate((h, free)), np.concatenate((c, np.zeros(len(free), np.uint64)))
                doc, v, start = (np.concatenate(x) for x in zip((doc, v, start), spans[:3], strict=True))
                strings = np.concatenate((strings, spans[3] - spans[2]))
                offset = np.concatenate((offset, np.full(len(free), -1)))
            columns = (h.view(np.int64), c.view(np.int64), doc, v, start, strings, offset)
            yield pa.record_batch([pa.array(x) for x in columns], [f.split()[0] for f in ANCHORS.split(", ")])


def merged(doc: np.ndarray, v: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans with those that overlap or touch within a document joined."""
    order = np.lexsort((begin, v, doc))
    doc, v, begin, end = (x[order] for x in (doc, v, begin, end))
    if not len(doc):
        return doc, v, begin, end
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (v[1:] != v[:-1])))
    # within a document contexts of a longer start end later or equally far, but folded ones need the running maximum
    group = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(end + group * (int(end.max()) + 1)) - group * (int(end.max()) + 1)
    head = fresh | np.concatenate(([True], begin[1:] > reach[:-1]))
    at = np.flatnonzero(head)
    return doc[at], v[at], begin[at], np.maximum.reduceat(end, at)


def repeated_strings(group: np.ndarray, rank: np.ndarray, offset: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which strings of each context (row, column of its start) stand in an earlier context of the same group.

    ``group`` numbers the anchors in ascending runs, ``rank`` the contexts in document order. The anchor stands in column ``GRAMS - 1``.
    """
    m, columns = len(texts), GRAMS - 1 + SIZE
    sizes = np.array([len(t) for t in texts], np.int64)
    symbols = np.full((m, columns), NONE, np.uint16)
    rows = np.repeat(np.arange(m), sizes)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[rows, within + np.repeat(GRAMS - 1 - offset, sizes)] = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((m, GRAMS), bool)
    order, common = np.arange(m), np.zeros(m, np.int64)  # common[i]: symbols that suffixes i - 1 and i of the order share
    beside = group[1:] == group[:-1]
    for column in range(columns - 1, -1, -1):
        inserted = symbols[order, column]
        move = np.argsort(group * (NONE + 1) + inserted, kind="stable")
        order, inserted = order[move], inserted[move]
        same = np.flatnonzero(beside & (inserted[1:] == inserted[:-1]) & (inserted[1:] != NONE))
        grown = np.zeros(m, np.int64)
        if len(same):
            pairs = np.stack((move[same] + 1, move[same + 1] + 1), 1).ravel()
            grown[same + 1] = 1 + np.minimum.reduceat(np.append(common, 0), pairs)[::2]
        common = grown
        if column >= GRAMS:
            continue
        equal = common >= SIZE
        member = np.flatnonzero(equal | np.append(equal[1:], False))
        if len(member):
            heads = np.flatnonzero(~equal[member])
            ranks = rank[order[member]]
            first = np.repeat(np.minimum.reduceat(ranks, heads), np.diff(np.append(heads, len(member))))
            out[order[member[ranks > first]], column] = True
    return out


def _insert(block: pa.Table) -> pa.RecordBatch:
    h, doc, v, start, a = (block[c].to_numpy() for c in ("h", "doc", "v", "start", "a"))
    anchor = start + a
    group = np.concatenate(([0], np.cumsum(h[1:] != h[:-1])))
    order = np.lexsort((anchor, v, doc))
    moved = [x[order][1:] != x[order][:-1] for x in (doc, v, anchor)]
    rank = np.empty(len(h), np.int64)  # equal for equal places: rows of equal key and text send the same contexts
    rank[order] = np.concatenate(([0], np.cumsum(moved[0] | moved[1] | moved[2])))
    found = repeated_strings(group, rank, a, block["context"].to_pylist())
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    begin = anchor[row] + first - (GRAMS - 1)
    end = anchor[row] + after - 1 - (GRAMS - 1) + SIZE
    return pa.record_batch([pa.array(x) for x in (doc[row], v[row], begin, end)], ["doc", "v", "begin", "end"])


def column_wise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated strings among contexts that come sorted by anchor, in blocks of whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < BLOCK:
            continue
        table = pa.Table.from_batches(held)
        h = table["h"].to_numpy()
        turns = np.flatnonzero(h[1:] != h[:-1])
        if len(turns):
            cut = int(turns[-1]) + 1
            yield _insert(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
    if held and sum(map(len, held)):
        yield _insert(pa.Table.from_batches(held))


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, runs of them, what is left) of a text without these spans."""
    pieces, at, gone, runs, reach = [], 0, 0, 0, -1
    for begin, end in sorted(spans):
        runs += begin > reach
        reach = max(reach, end)
        if end > at:
            pieces.append(data[at : max(begin, at)])
            gone += end - max(begin, at)
            at = end
    return gone, runs, b"".join((*pieces, data[at:]))


def _without(data: Column, spans: Column) -> Column:
    @F.arrow_udf("struct<n_removed:bigint,n_spans:bigint,kept:binary>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        for texts, lists in batches:
            made = [cut_out(t.as_py(), [(s["begin"], s["end"]) for s in x.as_py() or ()]) for t, x in zip(texts, lists, strict=True)]
            columns = [pa.array([m[k] for m in made], kinds[k]) for k in range(3)]
            yield pa.StructArray.from_arrays(columns, ["n_removed", "n_spans", "kept"])

    return cut(data, spans)


def _hot(docs: DataFrame, hot: int) -> np.ndarray:
    """Hashes of anchors in about ``hot`` contexts or more: at most one for as many contexts of the whole corpus."""
    nothing = np.empty(0, np.uint64)
    some = docs.where(F.pmod(F.xxhash64("doc", "v"), F.lit(SAMPLED)) == 0).mapInArrow(lambda b: contexts(b, nothing, fold=False), ANCHORS)
    often = some.groupBy("h").count().where(F.col("count") * SAMPLED >= hot).select("h").collect()
    return np.array([r.h for r in often], np.int64).view(np.uint64)


def removed(documents: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): each document without its repeated strings, ``kept`` as bytes."""
    spark = documents.sparkSession
    docs = pick(documents, id=key, text=text).select("id", F.coalesce(F.col("id").cast("long"), F.lit(SMALLEST)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    repeated = not docs.groupBy("doc").count().where("count > 1").isEmpty()
    docs = docs.select("id", "doc", (F.xxhash64("text") if repeated else F.lit(0).cast("long")).alias("v"), F.col("text").cast("binary").alias("data"))
    keys = ["doc", "v"] if repeated else ["doc"]
    often = _hot(docs, hot)

    rows = docs.select("doc", "v", "data").mapInArrow(lambda b: contexts(b, often), ANCHORS)
    anchor = Window.partitionBy("h")
    before = F.lag("c").over(anchor.orderBy("c", "doc", "v", "start"))
    rows = rows.withColumn("again", before.eqNullSafe(F.col("c"))).withColumn("shared", F.min("c").over(anchor) != F.max("c").over(anchor))
    place = ["doc", "v", "start"]
    rows = rows.withColumn("same", F.lag(F.struct(*place)).over(anchor.orderBy("c", *place)).eqNullSafe(F.struct(*place)))
    known = (F.col("a") == -1) | (F.col("again") & ~F.col("same"))
    rows = rows.select("h", "doc", "v", "start", "size", "a", known.alias("known")).where(F.col("known") | F.col("shared"))
    path = f"{shared_folder(spark)}/contexts"
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)

    asked = rows.where("not known").groupBy("doc", "v").agg(F.collect_set(F.struct("h", "start", "size", "a")).alias("asked"))
    part = lambda x: F.substring(F.col("data"), (x["start"] + 1).cast("int"), (x["size"] + SIZE - 1).cast("int"))
    listed = docs.join(asked.drop(*{"v"} - set(keys)), keys).select(
        "doc", "v", F.explode(F.transform("asked", lambda x: F.struct(x["h"].alias("h"), x["start"].alias("start"), x["a"].alias("a"), part(x).alias("context")))).alias("x")
    )
    grouped = listed.select("doc", "v", "x.*").repartition("h").sortWithinPartitions("h")
    width = F.when(F.col("a") == -1, F.col("size")).otherwise(F.col("size") + SIZE - 1)
    spans = rows.where("known").select("doc", "v", F.col("start").alias("begin"), (F.col("start") + width).alias("end"))
    spans = spans.unionByName(grouped.mapInArrow(column_wise, SPANS))
    spans = spans.groupBy("doc", "v").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    out = docs.join(spans.drop(*{"v"} - set(keys)), keys, "left").select(
        "id", "doc", "v", F.length("data").cast("long").alias("n_bytes"), _without(F.col("data"), F.col("spans")).alias("x")
    )
    out = out.select("id", "doc", "v", "n_bytes", "x.*")
    if repeated:
        out = _later_copies(out)
    return out.select(F.col("id").alias(key), "n_bytes", "n_removed", "n_spans", "kept")


def _later_copies(out: DataFrame) -> DataFrame:
    """Rows of equal key and text gave equal results; all but one of them are repeats from end to end."""
    columns = ["id", "doc", "v", "n_bytes", "n_removed", "n_spans", "kept"]
    copies = out.groupBy(*columns).count()
    each = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
    gone = (F.col("copy") > 1) & (F.col("n_bytes") >= SIZE)

    def or_else(name: str, value: Column) -> Column:
        return F.when(gone, value).otherwise(F.col(name)).alias(name)

    return each.select("id", "n_bytes", or_else("n_removed", F.col("n_bytes")), or_else("n_spans", F.lit(1).cast("long")), or_else("kept", F.lit(b"")))


ORACLE = """with texts as (select doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, '')) as n from documents),
strings as (
  select doc_id, i, min((doc_id, i)) over (partition by substr(x, 2 * i + 1, 200)) as first
  from (select doc_id, x, unnest(range(0, n - 99)) as i from texts)),
again as (
  select doc_id, i, i > 100 + coalesce(lag(i) over (partition by doc_id order by i), -101) as fresh from strings where first <> (doc_id, i)),
spans as (
  select doc_id, min(i) as a, max(i) + 100 as b
  from (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) as span from again) group by doc_id, span),
kept as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before,
    lead(a) over (partition by doc_id order by a) is null as last from spans),
pieces as (
  select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)) || case when last then substr(x, 2 * b + 1) else '' end, '' order by a) as k
  from kept join texts using (doc_id) group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(k, x))) as kept_sha256
from texts left join pieces using (doc_id)"""
