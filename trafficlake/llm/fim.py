"""Fill-in-middle: cut a text at two of its units by an indexable skip list and write its three parts in training order.

A text's units are runs of ASCII letters and single other characters. Its skip list has the units in the lowest lane, and
in each express lane above it one node for every ``FAN`` nodes below. A node carries two widths: how many units and how many
code points it spans. To reach the cut before unit ``rank``, the search goes along the top lane while the units passed stay
at or below ``rank``, then a lane down, and so on; the code points passed are where the text is cut.

Both cuts, the form and the order come from the hash of seed and key: the text as it is (``plain``), ``<P>``prefix``<S>``suffix``<M>``middle
(``psm``), or ``<S>``suffix``<P>``prefix``<M>``middle (``spm``). A text that holds a sentinel stays plain, so ``restored`` finds the first
sentinels of an output where the operator put them and rebuilds the text exactly.

A NULL text is empty, and an empty text is plain. A NULL key counts as the empty text in the hash. Each row stands alone: repeated
rows give equal results, an empty table an empty one, nothing is shuffled, and texts are cut whole at any length, one at a
time. Columns of a result's name are replaced by it; all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, with_results

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90  # of a hundred
SPM_BELOW = 20
FAN = 8
ROWS_AT_ONCE = 64
CUT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


class SkipList:
    """Units of one text under express lanes; ``offset(rank)`` is the code point where unit ``rank`` starts."""

    def __init__(self, text: str):
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = ((code | 32) >= ord("a")) & ((code | 32) <= ord("z"))
        starts = np.flatnonzero(~(letter & np.concatenate(([False], letter[:-1]))))
        points = np.diff(np.append(starts, len(code)))
        self.n_units, self.n_points = len(starts), len(code)
        self.lanes = [(np.ones(len(starts), np.int64), points)]
        while len(self.lanes[-1][0]) > FAN:
            heads = np.arange(0, len(self.lanes[-1][0]), FAN)
            self.lanes.append(tuple(np.add.reduceat(width, heads) for width in self.lanes[-1]))

    def offset(self, rank: int) -> int:
        if not 0 <= rank <= self.n_units:
            raise IndexError(rank)
        units = points = node = 0
        for unit_width, point_width in reversed(self.lanes):
            while node < len(unit_width) and units + unit_width[node] <= rank:
                units += int(unit_width[node])
                points += int(point_width[node])
                node += 1
            node *= FAN  # the first node below the one that was not passed
        return points


def cut(text: str, h: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix, of middle, output) of one text under four 32-bit draws."""
    units = SkipList(text)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= PLAIN_FROM:
        return units.n_units, "plain", None, None, text
    first, last = (units.offset(rank) for rank in sorted(x % (units.n_units + 1) for x in h[:2]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    spm = h[3] % 100 < SPM_BELOW
    parts = (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle) if spm else (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return units.n_units, "spm" if spm else "psm", first, last - first, "".join(parts)


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of each row."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)

    @F.arrow_udf(CUT)
    def transform(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names = ["n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for texts, hashes in batches:
            pieces = []
            for at in range(0, len(texts), ROWS_AT_ONCE):
                rows = [
                    cut(t.as_py() or "", tuple(int(h.as_py()[8 * i : 8 * i + 8], 16) for i in range(4)))
                    for t, h in zip(texts[at : at + ROWS_AT_ONCE], hashes[at : at + ROWS_AT_ONCE], strict=True)
                ]
                columns = zip(*rows, strict=True)
                pieces.append(pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names))
            yield pa.concat_arrays(pieces) if pieces else pa.array([], pa.struct(list(zip(names, kinds, strict=True))))

    made = with_results(df, _made=transform(F.col(f"`{text}`"), hashed))
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    return with_results(made, **{name: F.col(f"_made.{name}") for name in names}).drop("_made")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    def between(start: str, end: str) -> Column:
        at = F.locate(start, output) + len(start)
        return F.substr(output, at, F.locate(end, output) - at)

    def after(start: str) -> Column:
        return F.substr(output, F.locate(start, output) + len(start))

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """The results with the hashes of each output and of the text rebuilt from it, without the texts."""
    made = fill_in_middle(pick(documents, doc_id=key, text=text), "doc_id", "text", seed)
    return made.select(
        F.col("doc_id").alias(key),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || doc_id) as h from documents),
draws as (
  select *, len(u) as n, list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(h, 8 * i + 1, 8))::bigint) as d from units),
cuts as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d[3] % 100 >= 90 then 'plain'
      when d[4] % 100 < 20 then 'spm' else 'psm' end as form from draws),
parts as (
  select doc_id, text, n, form, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
    array_to_string(u[b + 1:n], '') as s from cuts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256 from parts"""
