"""Column-list operators: rename, drop, union, conform."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.functions.text import snake_case
from trafficlake.schemas import PARTITION_KEY, Table, table


def q(name: str) -> Column:
    """Column by its literal name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_by(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by a rule on its name."""
    return df.toDF(*[rule(c) for c in df.columns])


def rename_prefixes(df: DataFrame, prefixes: Mapping[str, str], fixed: Mapping[str, str]) -> DataFrame:
    """Replace leading name parts; names in ``fixed`` are renamed as given instead."""

    def rule(name: str) -> str:
        if name in fixed:
            return fixed[name]
        for old, new in prefixes.items():
            if name.startswith(old):
                return new + name[len(old):]
        return name

    return rename_by(df, rule)


def to_snake_case(df: DataFrame) -> DataFrame:
    return rename_by(df, snake_case)


def strip_names(df: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    return rename_by(df, lambda c: c.removesuffix(suffix).removeprefix(prefix))


def drop(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns by literal name; absent ones are ignored."""
    gone = set(columns)
    return df.select(*[q(c) for c in df.columns if c not in gone])


def drop_where(df: DataFrame, unwanted: Callable[[str], bool]) -> DataFrame:
    """Drop columns whose name meets a condition."""
    return drop(df, [c for c in df.columns if unwanted(c)])


def drop_twins(df: DataFrame, suffix: str = "Nullable", flag: str = "has") -> DataFrame:
    """Keep ``xNullable`` as ``x``; drop its twins ``x`` and ``hasX``."""
    bases = [c.removesuffix(suffix) for c in df.columns if c.endswith(suffix)]
    gone = {b for b in bases} | {flag + b[:1].upper() + b[1:] for b in bases}
    return strip_names(drop(df, gone), suffix=suffix)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union of rows; columns missing on one side are NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def demux(df: DataFrame, kind: str, wanted: Mapping[str, Sequence[str]], name: str = "target") -> DataFrame:
    """Rows of the kinds that ``wanted`` lists, under their kind as ``name``, each with its own columns and NULL in the others.

    What a union of one projection for each kind gives, in one pass over the rows.
    """
    columns = [*dict.fromkeys(c for own in wanted.values() for c in own)]
    rows = df.where(q(kind).isin(*wanted))
    return rows.select(
        q(kind).alias(name),
        *[F.when(q(kind).isin(*[k for k, own in wanted.items() if c in own]), q(c)).alias(c) for c in columns],
    )


def coalesce_present(df: DataFrame, *names: str) -> Column:
    """First non-NULL of those columns the frame has; none of them gives NULL text."""
    present = [q(c) for c in names if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def _as(df: DataFrame, field: T.StructField) -> Column:
    have = df.schema[field.name].dataType
    c = q(field.name)
    if have == field.dataType:
        return c
    if isinstance(have, T.StructType | T.ArrayType | T.MapType):
        return F.to_json(c)
    value = c.try_cast(field.dataType)
    if isinstance(field.dataType, T.StringType):
        return value
    message = F.concat(F.lit(f"{field.name} takes no value like: "), c.cast("string"))
    return F.when(value.isNotNull() | c.isNull(), value).otherwise(F.raise_error(message).cast(field.dataType))


def failed_casts(df: DataFrame, to: str | Table) -> DataFrame:
    """(column, n_failed) of the values that ``conform`` would fail on, counted in one pass."""
    target = table(to) if isinstance(to, str) else to
    nested = T.StructType | T.ArrayType | T.MapType
    cast = [
        f for f in target.schema.fields
        if f.name in df.columns and not isinstance(df.schema[f.name].dataType, nested)
    ]
    counts = [
        F.count(F.when(q(f.name).isNotNull() & q(f.name).try_cast(f.dataType).isNull(), 1)).alias(f.name) for f in cast
    ]
    pairs = ", ".join(f"'{f.name}', `{f.name}`" for f in cast)
    return df.agg(*counts).select(F.expr(f"stack({len(cast)}, {pairs}) as (column, n_failed)"))


def conform(df: DataFrame, to: str | Table, partition: Column | str | None = None) -> DataFrame:
    """Exactly the registered columns, in order and type.

    Missing columns are typed NULLs and extra columns vanish; an unregistered table is
    an error. A value that does not fit its stored type fails the job; ``failed_casts`` counts those. ``partition`` stamps the partition key of a partitioned table.
    """
    target = table(to) if isinstance(to, str) else to
    have = set(df.columns)
    columns = []
    for field in target.schema.fields:
        if field.name == PARTITION_KEY and partition is not None:
            value = F.lit(partition) if isinstance(partition, str) else partition
            c = value.cast(field.dataType)
        elif field.name in have:
            c = _as(df, field)
        else:
            c = F.lit(None).cast(field.dataType)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def schema_difference(left: DataFrame, right: DataFrame) -> list[tuple[str, str]]:
    """Columns only one of two frames has, as (name, side) in name order."""
    a, b = set(left.columns), set(right.columns)
    return sorted([(c, "left") for c in a - b] + [(c, "right") for c in b - a])
