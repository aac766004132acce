"""String expressions: paths, URLs, labels, classification."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.site import Site

# RFC 3986 component patterns
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*[?]([^#]*)"


def null_if_blank(c: Column) -> Column:
    """Empty text becomes NULL."""
    return F.when(c != "", c)


def dash_to_null(c: Column) -> Column:
    """The log's NULL mark ``-`` becomes NULL."""
    return F.when(c != "-", c)


def dash_or_blank_to_null(c: Column) -> Column:
    return F.when(~c.isin("-", ""), c)


def version_of(key: Column) -> Column:
    """Part of an object key before the first ``/``; ``-`` and empty are NULL."""
    return dash_or_blank_to_null(F.substring_index(key, "/", 1))


def table_of(key: Column) -> Column:
    """Part of an object key after the first ``/``; NULL without one."""
    return F.get(F.split(key, "/", 2), F.lit(1))


def object_path_of(name: Column) -> Column:
    """Everything after the first ``/``; empty is NULL."""
    return null_if_blank(F.regexp_extract(name, r"/([\s\S]*)$", 1))


def tag_of(name: Column) -> Column:
    """Everything before the first ``/`` (blanks before it dropped); none is NULL."""
    return null_if_blank(F.regexp_extract(name, r"^([^/]+?)(\s*[/])", 1))


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, netloc, path and query of a URL; missing parts are NULL."""
    return {
        "scheme": null_if_blank(F.lower(F.regexp_extract(url, _SCHEME, 1))),
        "netloc": null_if_blank(F.regexp_extract(url, _NETLOC, 1)),
        "path": null_if_blank(F.regexp_extract(url, _PATH, 1)),
        "query": null_if_blank(F.regexp_extract(url, _QUERY, 1)),
    }


def login_query(line: Column, redirect: str = r"next=/search(\?q%3D)?") -> Column:
    """What a user searched for before logging in, from the request line."""
    query = F.regexp_extract(line, _QUERY, 1)
    return F.replace(F.regexp_replace(query, redirect, ""), F.lit("+"), F.lit(" "))


def is_login(event: Column, line: Column, marker: str = "callback") -> Column:
    """A line without an event that reports the log-in callback."""
    return event.isNull() & F.coalesce(F.contains(line, F.lit(marker)), F.lit(False))


def first_word(c: Column) -> Column:
    return F.get(F.split(c, " ", 2), F.lit(0))


def after_first_word(c: Column) -> Column:
    return F.coalesce(F.get(F.split(c, " ", 2), F.lit(1)), F.when(c.isNotNull(), F.lit("")))


def full_location(city: Column, region: Column, country: Column) -> Column:
    """``city, region, country``; NULL if any part is."""
    return F.concat(city, F.lit(", "), region, F.lit(", "), country)


def joined_id(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL if any part is."""
    columns: list[Column] = []
    for part in parts:
        columns += [F.lit("_"), part] if columns else [part]
    return F.concat(*columns)


def replace_in_strings(
    df: DataFrame, pairs: Iterable[tuple[str, str]], containing: str | None = None
) -> DataFrame:
    """Regex replacements, one after the other, in every string column of the frame.

    ``containing`` names a text that every match holds: values without it, usually nearly
    all, then cost a substring search instead of one regex pass per pair.
    """
    pairs = list(pairs)
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            c = new = F.col(f"`{field.name}`")
            for pattern, replacement in pairs:
                new = F.regexp_replace(new, pattern, replacement)
            if containing is not None:
                new = F.when(F.contains(c, F.lit(containing)), new).otherwise(c)
            changed[field.name] = new
    return df.withColumns(changed)


def any_affix(c: Column, prefixes: Iterable[str] = (), suffixes: Iterable[str] = ()) -> Column:
    """True where ``c`` starts or ends with any of the texts; NULL counts as False.

    One pattern for all of them, so that ``c`` is evaluated once also where the optimizer
    moves this test below the projection that computes ``c``.
    """

    def quoted(texts: Iterable[str]) -> str:
        return "|".join(rf"\Q{t}\E" for t in texts)

    starts, ends = quoted(prefixes), quoted(suffixes)
    pattern = "|".join(([rf"\A(?:{starts})"] if starts else []) + ([rf"(?:{ends})\z"] if ends else []))
    return F.coalesce(F.rlike(c, F.lit(pattern)), F.lit(False)) if pattern else F.lit(False)


def any_pattern(c: Column, patterns: Iterable[str]) -> Column:
    """True where any regex matches; NULL text counts as False."""
    return F.coalesce(F.rlike(c, F.lit("|".join(patterns))), F.lit(False))


def usage_type(referer: Column, version: Column, day: Column, site: Site) -> Column:
    """Usage label: documentation link, viewer query, viewer link, other.

    Days before the cutoff carry one common label. NULL referers match nothing.
    """
    return (
        F.when(day < F.lit(site.usage_cutoff), site.label_before_cutoff)
        .when(F.rlike(referer, F.lit(site.docs_referer_pattern)), site.label_docs)
        .when(version == site.viewer_version, site.label_viewer_query)
        .when(F.startswith(referer, F.lit(site.viewer_referer_prefix)), site.label_viewer_link)
        .otherwise(site.label_other)
    )


def database_of(table: Column, label: str = "parquet_file") -> Column:
    """Parquet files share one label; anything else is its own database."""
    return F.when(F.rlike(table, F.lit(".parquet")), label).otherwise(table)


def snake_case(name: str) -> str:
    """camelCase to snake_case, one ``_`` before every inner capital."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()
