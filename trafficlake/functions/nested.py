"""Nested values: flattening, unpacking, widening, pruning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct leaf becomes a column named by its path; arrays and maps stay."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                dotted = ".".join(f"`{part}`" for part in here)
                out.append(F.col(dotted).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def lift(df: DataFrame, inner: str, *outer: str) -> DataFrame:
    """Fields of the struct ``inner`` next to some outer columns."""
    return df.select(f"{inner}.*", *outer)


def explode_array(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """One row per element of an array of structs; NULL and empty arrays give none.

    The outer form keeps the optimizer from testing the array in a filter of its own,
    which would parse JSON-derived arrays a second time.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("__pos", "__item"))
    return rows.where(F.col("__pos").isNotNull()).select(*keep, "__item.*")


def unpack_json(df: DataFrame, text: str, schema: str, prefix: str = "") -> DataFrame:
    """JSON object text to columns of the same row; NULL gives NULL columns."""
    fields = T.StructType.fromDDL(schema).names
    parsed = F.from_json(F.col(text), schema)
    return df.withColumns({prefix + name: parsed[name] for name in fields})


def json_list(text: Column, element: str) -> Column:
    """JSON list text to an array; anything but a list is NULL."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<{element}>"))


def is_bad_json_list(text: Column, element: str) -> Column:
    """Text is present but is not a readable JSON list."""
    return text.isNotNull() & json_list(text, element).isNull()


def widen(array: Column, fields: Mapping[str, str], slots: int, name) -> dict[str, Column]:
    """Fields of the first ``slots`` array elements as text columns ``name(ours, slot)``; ``fields``
    maps our name of a field to the element's. Keep the array too: it may be longer."""
    return {
        name(ours, slot): F.get(array, F.lit(slot))[theirs].cast("string")
        for slot in range(slots)
        for ours, theirs in fields.items()
    }


def nested_to_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Structs, arrays and maps as JSON text; other columns are left alone."""
    wanted = set(df.columns if columns is None else columns)
    changed = {
        field.name: F.to_json(F.col(f"`{field.name}`"))
        for field in df.schema.fields
        if field.name in wanted
        and isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType)
    }
    return df.withColumns(changed)


def drop_nested(df: DataFrame, column: str, *paths: str) -> DataFrame:
    """Remove fields (dotted paths) from a struct column; absent ones are ignored."""

    def has(schema: T.DataType, path: list[str]) -> bool:
        for part in path:
            if not isinstance(schema, T.StructType) or part not in schema.names:
                return False
            schema = schema[part].dataType
        return True

    schema = df.schema[column].dataType
    present = [p for p in paths if has(schema, p.split("."))]
    if not present:
        return df
    quoted = [".".join(f"`{part}`" for part in p.split(".")) for p in present]
    return df.withColumn(column, F.col(column).dropFields(*quoted))


def drop_in_array(df: DataFrame, column: str, *fields: str) -> DataFrame:
    """Remove fields from every struct of an array column."""
    inner = df.schema[column].dataType.elementType
    present = [f for f in fields if f in inner.names]
    if not present:
        return df
    return df.withColumn(
        column, F.transform(F.col(column), lambda item: item.dropFields(*present))
    )
