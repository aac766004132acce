"""Data-quality rules: keys, mappings, records, schemas."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.operators.columns import q
from trafficlake.schemas import Table

VIOLATIONS = "violations"


class DataQualityError(ValueError):
    """A quality rule does not hold."""


def key_violations(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, and how often. Counts combine before the shuffle."""
    return (
        df.groupBy(*[q(k).alias(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(count))
        .where(F.col(count) > 1)
    )


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Fail when a key repeats, naming three of them; ``key_violations`` lists all. For stored rows."""
    found = key_violations(df.select(*[q(k) for k in keys]), keys).limit(3).collect()
    if found:
        raise DataQualityError(f"{what}: key {tuple(keys)} repeats, e.g. {found}")


def _key_text(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[q(k) for k in keys]))


def unique_or_fail(df: DataFrame, keys: Sequence[str], what: str = "key repeats") -> DataFrame:
    """All rows; a job that uses any of them fails, naming a key, when a key repeats.

    The check is part of the job, so nothing runs while the plan is built and nothing is
    published when it fails. Rows are counted by key where they are shuffled to, so the input
    is evaluated once, and the check is a filter, which no projection or count leaves out.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*[q(k) for k in keys]))
    fine = F.when(F.col("__n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"{what}: "), _key_text(keys))).cast("boolean")
    )
    return df.withColumn("__n", n).where(fine).drop("__n")


def unique_by_counts(df: DataFrame, keys: Sequence[str], what: str = "key repeats") -> DataFrame:
    """The same for a frame whose keys are cheap to count apart: a stored table, or one whose shuffle both sides share.

    No row is shuffled for it, so a dimension can still be broadcast.
    """
    repeated = key_violations(df.select(*[q(k) for k in keys]), keys, "__n").agg(F.max(_key_text(keys))).scalar()
    message = F.concat(F.lit(f"{what}: "), repeated)
    # the id is what keeps the filter above a de-duplication, where it would part the shuffle from the counted one
    fine = F.when(repeated.isNull(), F.monotonically_increasing_id() >= 0).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(fine)


def require_balance(what: str, read: int, parts: Mapping[str, int]) -> None:
    """Fail unless every row read is in exactly one of the parts (accepted, rejected, dropped ..)."""
    if read != sum(parts.values()):
        raise DataQualityError(f"{what}: {read} rows read, but {dict(parts)}")


def unmapped(df: DataFrame, column: str, mapping: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``column``, NULL included, that the mapping does not list."""
    values = df.select(q(column).alias(column)).distinct()
    known = mapping.select(q(key).alias(column)).distinct()
    return values.join(known, column, "left_anti")


def mapped_or_fail(value: Column, mapped: Column, what: str) -> Column:
    """``mapped``; the job fails where a value, NULL included, has none. ``unmapped`` lists all of them."""
    message = F.concat(F.lit(f"no mapping for {what}: "), F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.coalesce(mapped, F.raise_error(message).cast("string"))


def _holds(rule: Column) -> Column:
    """A rule states what must hold; NULL counts as broken."""
    return F.coalesce(rule, F.lit(False))


def all_hold(rules: Mapping[str, Column]) -> Column:
    """One condition for all rules; it stops at the first broken one."""
    return functools.reduce(operator.and_, [_holds(rule) for rule in rules.values()])


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the broken rules of a row, as an array."""
    names = [F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*names))


def judged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows with the names of the rules they break, from one look at each: none means accepted."""
    return df.withColumn(VIOLATIONS, broken_rules(rules))


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that keep all rules."""
    return df.where(all_hold(rules))


def quarantined(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The other rows, with the names of the rules they break."""
    return df.where(~all_hold(rules)).withColumn(VIOLATIONS, broken_rules(rules))


def accepted_or_fail(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows; the job fails at the first one that breaks a rule (no extra pass)."""
    message = F.concat(
        F.lit("record breaks rules: "), F.array_join(broken_rules(rules), ", ")
    )
    passes = F.when(all_hold(rules), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return df.where(passes)


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows break each rule: one pass, one row per rule."""
    sums = [
        F.sum(F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1)).alias(name)
        for name, rule in rules.items()
    ]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *sums)
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return wide.select(
        F.expr(f"stack({len(rules)}, {pairs}) as (rule, n_broken)"), F.col("__rows").alias("n_rows")
    ).select("rule", F.coalesce("n_broken", F.lit(0)).cast("bigint").alias("n_broken"), "n_rows")


def schema_check(
    df: DataFrame, target: Table, patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """All failures of a frame against a registered table, counted in one pass.

    Per registered column: absent, values the type does not take, NULL in a key, or text
    that does not match its pattern; plus columns the registry does not know.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    rules: dict[str, Column] = {}
    for field in target.schema.fields:
        if field.name not in have:
            rules[f"{field.name}: missing"] = F.lit(False)
            continue
        c = q(field.name)
        kind = have[field.name]
        if kind != field.dataType and not isinstance(kind, T.StructType | T.ArrayType | T.MapType):
            rules[f"{field.name}: type"] = c.isNull() | c.try_cast(field.dataType).isNotNull()
        if field.name in target.key:
            rules[f"{field.name}: null key"] = c.isNotNull()
        pattern = (patterns or {}).get(field.name)
        if pattern:
            rules[f"{field.name}: pattern"] = c.isNull() | F.rlike(c.cast("string"), F.lit(pattern))
    for name in have.keys() - set(target.columns):
        rules[f"{name}: not registered"] = F.lit(False)
    return rule_counts(df, rules).where("n_broken > 0")
