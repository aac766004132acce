"""Time expressions: parsing, normalising, calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: time stamp of an object-store access log, e.g. [06/Feb/2019:00:00:38 +0000]
ACCESS_LOG_FORMAT = "'['dd/MMM/yyyy:HH:mm:ss Z']'"
DAY_PATTERN = r"\d{4}-\d{2}-\d{2}"


def access_log_text(time: Column, zone: Column) -> Column:
    """Time and zone fields of an access log as one text; NULL where either is."""
    return F.concat(time, F.lit(" "), zone)


def access_log_time(time: Column, zone: Column) -> Column:
    """Time and zone fields of an access log as one instant; bad text is NULL (see ``readable``)."""
    return F.try_to_timestamp(access_log_text(time, zone), F.lit(ACCESS_LOG_FORMAT))


def unreadable(text: Column, value: Column) -> Column:
    """True where there is a text that gave no ``value``."""
    return text.isNotNull() & value.isNull()


def iso_time(text: Column) -> Column:
    """ISO 8601 text as an instant; bad text is NULL."""
    return F.try_to_timestamp(text)


def iso_date(text: Column) -> Column:
    """Day of an ISO 8601 text; bad text is NULL."""
    return F.to_date(F.try_to_timestamp(text))


def readable(text: Column, value: Column, kind: str = "timestamp") -> Column:
    """``value``, read from ``text``; the job fails where there is a text that gave none."""
    message = F.concat(F.lit(f"unreadable {kind}: "), text)
    return F.when(~unreadable(text, value), value).otherwise(F.raise_error(message).cast(kind))


def day_start(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Midnight UTC of a day given as text; the job fails on any other text."""
    return readable(text, F.try_to_timestamp(text, F.lit(fmt)), "timestamp")


def micros_to_time(micros: Column) -> Column:
    """Microseconds since the epoch as an instant."""
    return F.timestamp_micros(micros)


def without_zone(c: Column) -> Column:
    """Instant as wall-clock time of the session zone (UTC)."""
    return c.cast("timestamp_ntz")


def date_in_text(text: Column) -> Column:
    """First ``YYYY-MM-DD`` in a text, e.g. a file name; none is NULL."""
    found = F.regexp_extract(text, f"({DAY_PATTERN})", 1)
    return F.when(found != "", found)


def week_ending(c: Column) -> Column:
    """Sunday that closes the Monday-to-Sunday week of ``c``."""
    return F.date_add(F.to_date(F.date_trunc("week", c)), 6)


def month_ending(c: Column) -> Column:
    """Last day of the month of ``c``."""
    return F.last_day(F.to_date(c))


def window_days(first: str, days: int) -> list[str]:
    """The ``days`` days that start with ``first``, as text."""
    start = dt.date.fromisoformat(first)
    return [(start + dt.timedelta(days=n)).isoformat() for n in range(days)]


def calendar(bounds: DataFrame, first: str, last: str, step: str, name: str = "day") -> DataFrame:
    """One row per step between two date columns of a one-row frame, both included."""
    return bounds.select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr(f"interval {step}"))).alias(name)
    )
