"""Reports: value counts, shares, calendar resampling, profiles, quartiles."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators.columns import q
from trafficlake.session import Staging

SKETCH = 10_000  # accuracy of the quantile sketch: one row in so many
SPLITS = 256
COLLECTED = 50_000  # counted values that may come to the driver


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Non-NULL values and their counts, most frequent first, ties by value."""
    counts = (
        df.where(q(column).isNotNull()).groupBy(q(column)).agg(F.count(F.lit(1)).alias("n"))
    )
    if top is None:
        return counts
    return counts.orderBy(F.col("n").desc(), q(column)).limit(top)


def shares_of(counts: DataFrame, top: int | None = None) -> DataFrame:
    """A table of counts (``n``) with each count's share of their sum.

    The total is one scalar of the counts; no window brings all values into one task.
    """
    total = counts.agg(F.sum("n").alias("total")).scalar()
    shares = counts.withColumn("share", F.col("n") / total)
    if top is None:
        return shares
    return shares.orderBy(F.col("n").desc(), *[q(c) for c in counts.columns if c != "n"]).limit(top)


def value_shares(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """As ``value_counts`` with each count's share of all non-NULL rows."""
    return shares_of(value_counts(df, column), top)


def top_shares(df: DataFrame, column: str, top: int, covered: str | None = None) -> DataFrame:
    """The ``top`` values as ``value_shares`` has them and, under the name ``covered``, the share they cover together.

    One aggregate counts the values and, as its grand total, all rows; what follows sees ``top`` + 1 of its rows.
    """
    value = q(column)
    counts = df.where(value.isNotNull()).rollup(value).agg(F.count(F.lit(1)).alias("n"), F.grouping(column).alias("all"))
    first = counts.orderBy(F.col("all").desc(), F.col("n").desc(), value).limit(top + 1)
    found = first.agg(
        F.max(F.when(F.col("all") == 1, F.col("n"))).alias("total"),
        F.sort_array(F.collect_list(F.when(F.col("all") == 0, F.struct((-F.col("n")).alias("k"), value.alias("v"))))).alias("rows"),
    )
    row = lambda v, n, share: F.struct(v.alias(column), n.cast("bigint").alias("n"), share.alias("share"))
    rows = F.transform("rows", lambda r: row(r["v"], -r["k"], -r["k"] / F.col("total")))
    if covered is not None:
        together = -F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, r: a + r["k"]) / F.col("total")
        rows = F.concat(rows, F.array(row(F.lit(covered), F.lit(None), together)))
    return found.select(F.inline(rows))


def covered_share(shares: DataFrame) -> DataFrame:
    """Share of all counted rows that the given (top) values cover together."""
    return shares.agg(F.sum("share").alias("covered"))


def matching(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Rows whose text contains any of the words (regex alternation)."""
    return df.where(F.rlike(q(column), F.lit("|".join(words))))


def _resample(df: DataFrame, ts: str, period: Column, step: str, measures: Sequence[Column]):
    """Aggregate per period, then put the periods without rows back with zeros.

    The calendar has one row per week or month between the first and the last one, so
    the second join is tiny; the heavy part is one combining aggregate.
    """
    filled = df.where(q(ts).isNotNull()).groupBy(period.alias("period")).agg(*measures)
    bounds = filled.agg(F.min("period").alias("first"), F.max("period").alias("last"))
    if step == "1 month":
        # step from month starts, so that short months do not shift the days
        starts = bounds.select(
            F.trunc("first", "month").alias("first"), F.trunc("last", "month").alias("last")
        )
        days = times.calendar(starts, "first", "last", step, "period")
        days = days.select(F.last_day("period").alias("period"))
    else:
        days = times.calendar(bounds, "first", "last", step, "period")
    values = [c for c in filled.columns if c != "period"]
    joined = days.join(filled, "period", "left")
    return joined.select("period", *[F.coalesce(q(v), F.lit(0)).alias(v) for v in values])


def resample_weekly(df: DataFrame, ts: str, *measures: Column) -> DataFrame:
    """Monday-to-Sunday weeks labelled by their Sunday; weeks without rows give zeros."""
    return _resample(df, ts, times.week_ending(q(ts)), "7 days", measures)


def resample_monthly(df: DataFrame, ts: str, *measures: Column) -> DataFrame:
    """Months labelled by their last day; months without rows give zeros."""
    return _resample(df, ts, times.month_ending(q(ts)), "1 month", measures)


def null_split(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value."""
    return df.groupBy(q(column).isNull().alias("is_null")).agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """Type, NULL and non-NULL count of every column in one pass, one row per column."""
    counts = [F.count(q(c)).alias(c) for c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = ", ".join(f"'{c}', '{kinds[c]}', `{c}`" for c in df.columns)
    tall = wide.select("__rows", F.expr(f"stack({len(df.columns)}, {pairs}) as (column, type, n_values)"))
    return tall.select(
        "column",
        "type",
        "n_values",
        (F.col("__rows") - F.col("n_values")).alias("n_nulls"),
        ((F.col("n_values") == 0) & (F.col("__rows") > 0)).alias("all_null"),
    )


def argmax_row(df: DataFrame, column: str, *ties: Column) -> DataFrame:
    """The row holding the largest value; ``ties`` decide among equals."""
    return df.where(q(column).isNotNull()).orderBy(q(column).desc(), *ties).limit(1)


def load_report(df: DataFrame, ts: str) -> DataFrame:
    """Row count, first and last instant."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("min_date"),
        F.max(ts).alias("max_date"),
    )


def _bracket(wanted: float) -> tuple[float, float]:
    """Shares at which a sketch's values, off by one in ``SKETCH`` rows at most, lie on either side of the wanted place."""
    return max(0.0, wanted - 2 / SKETCH), min(1.0, wanted + 2 / SKETCH)


def _values_at(counts: DataFrame, ranks: Sequence[int]) -> dict[int, float]:
    """The values at 0-based ranks of a staged table of values (v) and how often they occur (n)."""
    found, before = {}, 0
    head = counts.orderBy("v").limit(COLLECTED + 1).collect()
    if len(head) <= COLLECTED:
        wanted = sorted(ranks)
        for row in head:
            before += row["n"]
            while wanted and wanted[0] < before:
                found[wanted.pop(0)] = row["v"]
        return found
    # split where a sketch puts equal numbers of values, count the parts exactly, go on in those that hold a rank
    shares = F.array(*[F.lit(k / SPLITS) for k in range(1, SPLITS)])
    cuts = sorted(set(counts.agg(F.percentile_approx("v", shares, SKETCH)).first()[0]))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("v")))
    sizes = counts.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect()
    for row in sorted(sizes, key=lambda r: r["part"]):
        inside = [r - before for r in ranks if before <= r < before + row["n"]]
        if inside:
            found |= {r + before: v for r, v in _values_at(counts.where(part == row["part"]), inside).items()}
        before += row["n"]
    return found


def _summary(numbers: DataFrame, probabilities: Sequence[float]) -> tuple[Row, list[float | None]]:
    """(n, mean, min and max; the quantiles) of a column v, in two passes over it.

    The first pass keeps a mergeable quantile sketch, which brackets each wanted rank between two values. The second counts
    exactly how many rows lie in each gap between the brackets and how often each value inside them occurs; those counts,
    a small share of the values, are staged and searched. No task ever holds all values.
    """
    shares = [x for p in probabilities for x in _bracket(p)]
    first = numbers.agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.percentile_approx("v", F.array(*map(F.lit, shares)), SKETCH).alias("sketch"),
    ).first()
    n = first["n"]
    if not n:
        return first, [None] * len(probabilities)
    bounds = [(first["sketch"][2 * i], first["sketch"][2 * i + 1]) for i in range(len(probabilities))]
    if n <= COLLECTED:  # so few rows that a bracket could be narrower than the place between two of them
        bounds = [(first["min"], first["max"])]
    merged: list[list[float]] = []
    for low, high in sorted(bounds):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    inside = functools.reduce(operator.or_, [F.col("v").between(low, high) for low, high in merged])
    # part 2k is the gap below bracket k, part 2k + 1 the bracket itself
    part = functools.reduce(operator.add, [(F.col("v") >= low).cast("int") + (F.col("v") > high).cast("int") for low, high in merged])
    with Staging(numbers.sparkSession) as stage:
        counts = stage.keep(numbers.groupBy(part.alias("part"), F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")))
        sizes = {int(r["part"]): r["n"] for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect()}

        positions = [p * (n - 1) for p in probabilities]
        ranks = {int(x) for x in positions} | {min(int(x) + 1, n - 1) for x in positions}
        found, before = {}, 0
        for k in range(1, 2 * len(merged), 2):
            before += sizes.get(k - 1, 0)
            inside = [r - before for r in ranks if before <= r < before + sizes.get(k, 0)]
            if inside:
                values = _values_at(counts.where(F.col("part") == k).select("v", "n"), inside)
                found |= {r + before: v for r, v in values.items()}
            before += sizes.get(k, 0)
        if found.keys() != ranks:
            raise ValueError("the sketch missed a rank")  # its error bound rules this out
    out = []
    for x in positions:
        below, above = found[int(x)], found[min(int(x) + 1, n - 1)]
        share = x - int(x)
        out.append(below if share == 0 or below == above else below + (above - below) * share)
    return first, out


def _numbers(df: DataFrame, column: str) -> DataFrame:
    return df.select(q(column).cast("double").alias("v")).where("v is not null and not isnan(v)")


def quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> list[float | None]:
    """Exact quantiles, linear between neighbours, of a column with any number of rows.

    NULL and NaN are left out; infinities are values like others.
    """
    return _summary(_numbers(df, column), probabilities)[1]


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, min, quartiles and max of a numeric column, as one row; two passes over the input."""
    first, values = _summary(_numbers(df, column), [p for p, _ in _QUARTILES])
    row = (first["n"], first["mean"], first["min"], *values, first["max"])
    names = ["n", "mean", "min", *[name for _, name in _QUARTILES], "max"]
    schema = ", ".join(f"{name} {'bigint' if name == 'n' else 'double'}" for name in names)
    return df.sparkSession.createDataFrame([row], schema)


_QUARTILES = ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
