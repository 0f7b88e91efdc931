"""Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = str | dt.date


def day_lit(day: Day) -> Column:
    """A DATE literal from ``YYYY-MM-DD`` text or a date."""
    return F.lit(day_text(day)).cast("date")


def day_text(day: Day) -> str:
    """``YYYY-MM-DD`` text, checked to be a real date (safe to place in a partition spec)."""
    value = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    return value.strftime("%Y-%m-%d")


def event_day(column: str | Column) -> Column:
    """The calendar day of a timestamp, or of timestamp text; null where the text is no timestamp.

    Text must begin with a whole date: a bare time would take the day of the clock, a bare year its
    first day. Text with a zone counts on its day in the session's zone, UTC.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.when(dated(column), column.try_cast("timestamp")).cast("date")


def dated(column: Column) -> Column:
    return column.cast("string").rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])")


def on_day(column: str | Column, day: Day) -> Column:
    """Day equality."""
    return event_day(column) == day_lit(day)


def up_to_day(column: str | Column, day: Day) -> Column:
    """Day upper bound, inclusive whatever the hour."""
    return event_day(column) <= day_lit(day)


def anchor_of(run_date: str | Column) -> Column:
    """The day a run works on: the day before its run date."""
    return F.date_sub(run_date, 1)


def hash_key(*columns: str | Column) -> Column:
    """64-bit surrogate key."""
    return F.xxhash64(*columns)


def hash_key_md5(*columns: str | Column) -> Column:
    """Surrogate key as md5 text over ``|``-joined values, the same in every SQL engine."""
    return F.md5(F.concat_ws("|", *[_as_text(c) for c in columns]))


def _as_text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def partition_group(
    day: str | Column, as_of: Day | Column, months: int = 3, years: int = 2
) -> Column:
    """First day of the storage group of a day partition.

    Days at least ``years`` calendar years before ``as_of`` are grouped by year, days at least
    ``months`` calendar months before by month, later days stay on their own.
    """
    day = F.col(day) if isinstance(day, str) else day
    now = as_of if isinstance(as_of, Column) else day_lit(as_of)
    age_years = F.year(now) - F.year(day)
    age_months = age_years * 12 + F.month(now) - F.month(day)
    return (
        F.when(age_years >= years, F.trunc(day, "year"))
        .when(age_months >= months, F.trunc(day, "month"))
        .otherwise(day)
    )
