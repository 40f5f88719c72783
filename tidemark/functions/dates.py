"""Date expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import OPEN_END


def as_day(value: date | str | Column) -> Column:
    """Typed date column from a date, an ISO string or a date column.

    Anything else, and a string that is no ISO date, is an error here rather
    than an empty report later.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = date.fromisoformat(value)
    if isinstance(value, datetime) or not isinstance(value, date):
        raise ValueError(f"not a date: {value!r}")
    return F.lit(value)


def is_open(end: str | Column) -> Column:
    """True where the interval has not ended; null where the end is null."""
    return (F.col(end) if isinstance(end, str) else end) == F.lit(OPEN_END)


def later_of(a: Column, b: Column) -> Column:
    """The later date, and null if either is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def earlier_of(a: Column, b: Column) -> Column:
    """The earlier date, and null if either is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``; negative if the interval is inverted."""
    return F.date_diff(end, start)


def previous_month(day: date | str | Column) -> tuple[Column, Column]:
    """First and last day of the month before the one ``day`` lies in."""
    month_ago = F.add_months(as_day(day), -1)
    return F.trunc(month_ago, "MM"), F.last_day(month_ago)

