"""Removal of repeated lines by overlapping windows of three lines, in DataFrame operations only.

Each document is cut into lines at ``\\n``. Every three consecutive lines that are not all blank form a window, known by
two 64-bit hashes of its lines. The first occurrence of a window is the one with the smallest (document, position) of
the whole corpus; all others are later ones. The positions that later occurrences cover are merged to runs and their
lines are removed; the other lines stay in order.

Windows of one document may repeat each other too: of ``a a a a a a`` the lines before the first later window stay.
Lines are compared as they are, case and blanks included; lines of blanks alone count as empty. Documents of under three lines have no window and stay as
they are, as do NULL and empty texts. Documents are ordered by their key, then by the hash of their text; rows with the
same key and text are one document and get the same result. A NULL key sorts first. An empty table gives an empty result;
columns named as a result are replaced, others are kept.

One shuffle carries the hashes of windows, one the windows that are repeated (a heavy window is split by the skew join,
its minimum is combined before the shuffle), and one the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import with_results

WINDOW = 3


def _windows(docs: DataFrame) -> DataFrame:
    """(doc, pos, a, b), one row for each window of the ``text`` of ``docs`` with a line that is not blank."""
    line = lambda x: F.xxhash64(F.when(F.trim(x) == "", F.lit("")).otherwise(x))
    # a column of its own, so that windows look lines up and do not hash them again
    hashed = docs.select("doc", F.transform(F.split("text", "\n"), line).alias("h"))
    blank = F.xxhash64(F.lit(""))

    def window(x: Column, i: Column) -> Column:
        y, z = F.get("h", i + 1), F.get("h", i + 2)
        empty = (x == blank) & (y == blank) & (z == blank)
        a, b = F.xxhash64(x, y, z).alias("a"), F.xxhash64(F.lit("again"), z, x, y).alias("b")
        return F.when(z.isNotNull() & ~empty, F.struct(i.alias("pos"), a, b))

    windows = F.filter(F.transform("h", window), lambda w: w.isNotNull())
    return hashed.where(F.size("h") >= WINDOW).select("doc", F.explode(windows).alias("w")).select("doc", "w.*")


def kept_runs(starts: Column, n: Column) -> Column:
    """Runs (start, size) of the positions 0 to n - 1 that no window covers; ``starts`` ascend."""
    after = lambda i: F.get(starts, i - 1) + WINDOW
    run = lambda i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(after(i)).alias("start"),
        F.when(i == F.size(starts), n).otherwise(F.get(starts, i)).alias("end"),
    )
    runs = F.transform(F.sequence(F.lit(0), F.size(starts)), run)
    return F.filter(runs, lambda r: r["end"] > r["start"])


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with later repeats taken out of ``text``, plus ``n_lines`` before and ``n_removed``.

    NULL texts have no lines. Columns named ``n_lines`` or ``n_removed`` are replaced.
    """
    columns = [c for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    doc = F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    docs = df.select(doc.alias("doc"), F.col(f"`{text}`").alias("text"))
    windows = _windows(docs)
    where = F.struct("doc", "pos")
    repeated = windows.groupBy("a", "b").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = (
        windows.join(repeated.select("a", "b", "first"), ["a", "b"])
        .where(~(where.eqNullSafe(F.col("first"))))
        .groupBy(F.col("doc.key").alias("k"), F.col("doc.hash").alias("h"))
        .agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    )
    rows = df.select(row.alias("row"), doc["key"].alias("key"), doc["hash"].alias("hash"))
    joined = rows.join(later, F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h")), "left")
    lines = F.split(F.col("row").getField(text), "\n")
    joined = joined.withColumn("lines", F.when(F.col("starts").isNotNull(), lines))
    runs = F.when(F.col("starts").isNotNull(), kept_runs(F.col("starts"), F.size("lines")))
    joined = joined.withColumn("runs", runs)
    kept = F.flatten(F.transform("runs", lambda r: F.slice("lines", r["start"] + 1, r["end"] - r["start"])))
    joined = joined.withColumn("kept", kept)
    plain = F.col("row").getField(text)
    cleaned = F.when(F.col("kept").isNull(), plain).otherwise(F.array_join("kept", "\n"))
    n_lines = F.when(plain.isNull(), 0).otherwise(F.size(F.split(plain, "\n")))
    out = [cleaned.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns]
    removed = F.when(F.col("kept").isNull(), 0).otherwise(F.size("lines") - F.size("kept"))
    return joined.select(*out, n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


ORACLE = """with lines as (
  select doc_id, i as pos, ls[i + 1] as line, len(ls) as n
  from (select doc_id, string_split(text, chr(10)) as ls, unnest(range(len(string_split(text, chr(10))))) as i
        from documents)),
plain as (select doc_id, pos, case when trim(line, ' ') = '' then '' else line end as line from lines),
windows as (
  select a.doc_id, a.pos, a.line || chr(10) || b.line || chr(10) || c.line as w
  from plain a join plain b on a.doc_id = b.doc_id and b.pos = a.pos + 1
    join plain c on a.doc_id = c.doc_id and c.pos = a.pos + 2
  where a.line <> '' or b.line <> '' or c.line <> ''),
later as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by w order by doc_id, pos) as k from windows) where k > 1),
gone as (
  select distinct doc_id, pos + d as pos from later, (values (0), (1), (2)) t(d)),
kept as (
  select doc_id, string_agg(line, chr(10) order by pos) as text, count(*) as n_kept
  from lines anti join gone using (doc_id, pos) group by doc_id)
select d.doc_id, coalesce(k.text, case when d.text is not null then '' end) as text,
  coalesce(len(string_split(d.text, chr(10))), 0) as n_lines,
  coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n_kept, 0) as n_removed
from documents d left join kept k using (doc_id)"""
