"""Similarity join of documents on word shingles by a MinHash LSH forest, verified exactly.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more.

1. Equal texts are one distinct text; only those go on, with the number of their copies.
2. A signature of ``TREES * DEPTH`` MinHash values is cut into one path per tree. Texts that share the first d values
   of a path share a trie node of that depth. The join starts at the longest prefix that meets pairs right at the
   threshold with probability ``FIRST`` and shortens it while the recall it estimates is below ``TARGET``: each pair
   that is met counts for one over the probability of its being met at all.
3. Rows sorted by node are scanned in runs. A node of more texts than ``BLOCK`` is dealt out as pairs of blocks, so no
   task holds a whole hot node, and texts whose signatures disagree widely are not linked. A run gives back one row for
   each of its texts, with the smallest text it hangs together with: never all pairs.
4. Connected candidates form groups. The shingle sets of each group are compared exactly, again by pairs of blocks,
   and a run gives each text the number of its links in that run and its local root.
5. The linked texts' components are the classes. Copies are counted through the weight of their text.

Nothing is capped: the number of links of a document counts every other document it is linked to. A NULL text counts
as empty; texts without words are alike (similarity 1) and unlike all others. Rows that repeat, or that share an id, are
documents of their own. An empty table gives an empty result, texts of any length are taken whole, and other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.components import components
from trafficlake.llm.frames import cut, pick
from trafficlake.llm.shingles import mix, shingle_set

WORDS = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 6
FIRST = 0.98
TARGET = 0.995
BLOCK = 256
LOOSE = 0.15  # signatures estimate similarity with a standard error of 0.04, so this is four of them
ROWS_PER_BATCH = 256

_seeds = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
_table = pa.Table


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash under each of the hash functions; zeros for no shingles."""
    best = np.full(len(_seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _seeds
        np.minimum(best, (part ^ (part >> np.uint64(32))).min(0), out=best)
    return (mix(best) >> np.uint64(48)).astype(np.uint16) if len(shingles) else np.zeros(len(_seeds), np.uint16)


def met(similarity: np.ndarray, depth: int) -> np.ndarray:
    """Probability that a pair shares a prefix of that depth in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict]:
    """Columns of each run of rows with equal keys, from sorted batches. A run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield _table.from_batches(held).to_pydict()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield _table.from_batches(held).to_pydict()


def _local_roots(n: int, linked: np.ndarray) -> np.ndarray:
    """Smallest index of each component of a symmetric n by n matrix of links."""
    root = np.arange(n)
    while True:
        low = np.where(linked, root[None, :], n).min(1)
        new = np.minimum(root, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` of groups of two and more, dealt out to pairs of blocks (i, j) of their group; ``part`` is i or j."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    blocks = rows.join(sizes, group).withColumn("parts", parts)
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("tid", F.lit("part")), F.col("parts")).cast("int"))
    other = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = {"i": F.least("part", "other").cast("int"), "j": F.greatest("part", "other").cast("int")}
    return other.withColumns(pair).drop("n", "parts", "other")


def _scan(rows: DataFrame, group: str, work: Callable[[dict, bool], Iterator[tuple]], schema: str) -> DataFrame:
    """``work`` over each pair of blocks, told whether both are the same block."""
    keys = [group, "i", "j"]
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"binary": pa.binary(), "long": pa.int64(), "double": pa.float64()}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for run in _runs(batches, keys):
            # a text may come twice where rows of the input are repeated
            first = {t: k for k, t in reversed(list(enumerate(run["tid"])))}
            order = sorted(first)
            run = {c: [v[first[t]] for t in order] for c, v in run.items()}
            if len(order) > 1:
                out.extend(work(run, run["i"][0] == run["j"][0]))
            if len(out) > 4096:
                yield pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(scan, schema)


def _across(run: dict, same: bool) -> np.ndarray:
    """Which pairs of a run belong to it: all of one block, or those between two blocks."""
    part = np.array(run["part"])
    pairs = np.ones((len(part),) * 2, bool) if same else part[:, None] != part[None, :]
    np.fill_diagonal(pairs, False)
    return pairs


def _candidates(nodes: DataFrame, depth: int, threshold: float) -> DataFrame:
    """(tid, root, met, all): local roots of texts that share a node; pairs met, and pairs there may be in all."""

    def work(run: dict, same: bool) -> Iterator[tuple]:
        sig = np.frombuffer(b"".join(run["sig"]), np.uint16).reshape(-1, len(_seeds))
        n, tree = len(sig), run["tree"][0]
        likeness = np.empty((n, n))
        earlier = np.zeros((n, n), bool)
        prefixes = sig.reshape(n, TREES, DEPTH)[:, :tree, :depth]
        for k in range(n):
            likeness[k] = (sig == sig[k]).mean(1)
            if tree:
                earlier[k] = (prefixes == prefixes[k]).all(2).any(1)
        mine = _across(run, same) & (likeness >= threshold - LOOSE)
        root = _local_roots(n, mine)
        new = np.triu(mine & ~earlier & (likeness >= threshold))
        weight = np.where(new, 1 / met(np.maximum(likeness, threshold), depth), 0).sum(1)
        for k in np.flatnonzero(mine.any(1)):
            yield run["tid"][k], run["tid"][root[k]], float(new[k].sum()), float(weight[k])

    return _scan(_dealt(nodes, "node"), "node", work, "tid binary, root binary, met double, all double")


def _verified(sets: DataFrame, threshold: float) -> DataFrame:
    """(tid, root, links): exact comparison of the shingle sets of each group."""

    def work(run: dict, same: bool) -> Iterator[tuple]:
        shingles = [np.frombuffer(s, np.uint64) for s in run["shingles"]]
        n, sizes = len(shingles), np.array([len(s) for s in shingles])
        owner = np.repeat(np.arange(n), sizes)
        _, where, counts = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
        shared = counts > 1
        column = np.cumsum(shared) - 1
        chosen = shared[where]
        owner, where = owner[chosen], column[where[chosen]]
        order = np.argsort(where, kind="stable")
        owner, where = owner[order], where[order]
        common = np.zeros((n, n), np.float64)
        for at in range(0, int(shared.sum()), 2048):
            a, b = np.searchsorted(where, (at, at + 2048))
            x = np.zeros((n, 2048), np.float32)
            x[owner[a:b], where[a:b] - at] = 1
            common += x @ x.T
        union = sizes[:, None] + sizes[None, :] - common
        linked = _across(run, same) & (common >= threshold * union - 1e-9)
        copies = np.array(run["copies"])
        links, root = (linked * copies[None, :]).sum(1), _local_roots(n, linked)
        for k in np.flatnonzero(links):
            yield run["tid"][k], run["tid"][root[k]], int(links[k])

    return _scan(_dealt(sets, "group"), "group", work, "tid binary, root binary, links long")


def _signed(docs: DataFrame) -> DataFrame:
    """(key, tid, sig) of each (key, tid, text)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [signature(shingle_set(t.as_py(), WORDS)).tobytes() for t in batch["text"]]
            yield pa.record_batch([batch["key"], batch["tid"], pa.array(sigs, type=pa.binary())], ["key", "tid", "sig"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(sign, f"key {kind}, tid binary, sig binary")


def _with_sets(rows: DataFrame) -> DataFrame:
    """(group, tid, copies, shingles) of each (group, tid, copies, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingle_set(t.as_py(), WORDS).tobytes() for t in batch["text"]], type=pa.binary())
            yield pa.record_batch([batch["group"], batch["tid"], batch["copies"], sets], ["group", "tid", "copies", "shingles"])

    return rows.mapInArrow(make, "group binary, tid binary, copies long, shingles binary")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``key``, ``tid`` and ``root`` (128-bit hashes of its text and of its class's first text),
    ``class_id``, ``n_links`` and ``n_copies``.

    ``class_id`` is the smallest key of all documents that hang together by links; ``n_links`` is the number of other
    documents this one is linked to; ``n_copies`` is the number of documents with its very text, itself included.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    plain = F.coalesce(F.col("text"), F.lit(""))
    words = F.when(F.trim(F.translate(plain, "\t\n\x0b\x0c\r", "     ")) == "", F.lit("")).otherwise(plain)
    docs = pick(df, key=key, text=text).select("key", F.unhex(F.md5(words)).alias("tid"), words.alias("text"))
    signed = cut(_signed(docs))
    first = F.min("key").alias("rep")
    texts = cut(signed.groupBy("tid").agg(first, F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig")))

    depth = next(d for d in range(DEPTH, 0, -1) if d == 1 or met(np.array(threshold), d) >= FIRST)
    while True:
        start = F.col("tree") * (2 * DEPTH) + 1
        prefix = F.substring(F.col("sig"), start, F.lit(2 * depth))
        nodes = texts.select("tid", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
        nodes = nodes.select("tid", F.col("tree").cast("long").alias("tree"), F.xxhash64("tree", prefix).alias("node"))
        shared = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("node")
        members = nodes.join(shared, "node").join(texts.select("tid", "sig"), "tid")
        candidates = cut(_candidates(members, depth, threshold))
        seen = candidates.agg(F.sum("met"), F.sum("all")).first()
        if depth == 1 or not seen[1] or seen[0] / seen[1] >= TARGET:
            break
        depth -= 1

    groups = components(candidates.select(F.col("tid").alias("a"), F.col("root").alias("b")))
    chosen = groups.join(texts.select(F.col("tid").alias("id"), "rep", "copies"), "id")
    chosen = chosen.select(F.col("id").alias("id"), F.col("root").alias("group"), "rep", "copies")
    same = (F.col("tid") == F.col("id")) & F.col("key").eqNullSafe(F.col("rep"))
    sets = _with_sets(docs.join(chosen, same).select("group", "tid", "copies", "text"))
    verified = cut(_verified(sets, threshold))

    roots = components(verified.select(F.col("tid").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("tid").agg(F.sum("links").alias("links"))
    linked = texts.select("tid", "rep", "copies").join(links, "tid", "left")
    linked = linked.join(roots.select(F.col("id").alias("tid"), "root"), "tid", "left")
    linked = linked.select("tid", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "tid").alias("root"))
    ids = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    per_text = linked.join(ids, "root").select("tid", "root", "class_id", "copies", "links")
    out = signed.select("key", "tid").join(per_text, "tid")
    n_links = (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links")
    return out.select(F.col("key").alias(key), "tid", "root", "class_id", n_links, F.col("copies").alias("n_copies"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of ``df`` that stay when each class keeps one: the smallest key, then the smallest text hash.

    Rows that repeat a kept one in key and text go too.
    """
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    of = classes(df, key, text)
    kept = of.groupBy("root").agg(F.min(F.struct(F.col(f"`{key}`").alias("k"), "tid")).alias("m")).select("m.*")
    # texts of white space alone count as the empty one
    blank = F.trim(F.translate(plain, "\t\n\x0b\x0c\r", "     ")) == ""
    own = F.unhex(F.md5(F.when(blank, F.lit("")).otherwise(plain)))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("row"), F.col(f"`{key}`").alias("k1"), own.alias("t1"))
    hit = rows.join(kept, F.col("k1").eqNullSafe(F.col("k")) & (F.col("t1") == F.col("tid")), "left_semi")
    return hit.dropDuplicates(["k1", "t1"]).select("row.*")
