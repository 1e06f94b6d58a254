"""Boolean columns that never yield NULL, so they are safe to negate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def truth(cond: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def in_period(col: Column, beg: dt.date, end: dt.date) -> Column:
    """Inclusive date range; a missing date lies outside."""
    return truth(col.between(F.lit(beg), F.lit(end)))


def in_month(col: Column, any_day: dt.date) -> Column:
    """Date in the month of ``any_day``, as a range, so the scan can use it."""
    first = any_day.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    return truth((col >= F.lit(first)) & (col < F.lit(following)))


def month_text_is(col: Column, month: str) -> Column:
    """Month membership of a date column by its ``yyyyMM`` text."""
    return truth(F.date_format(col, "yyyyMM") == F.lit(month))


def is_one_of(col: Column, values) -> Column:
    return truth(col.isin(*values))


def has_text(col: Column, text: str) -> Column:
    return truth(col.contains(text))


def matches(col: Column, pattern: str) -> Column:
    return truth(col.rlike(pattern))


def within_tolerance(left: Column, right: Column, tolerance) -> Column:
    return truth(F.abs(left - right) <= F.lit(tolerance))


def amount_ok(col: Column, low=None, high=None) -> Column:
    """Amount present and inside the given bounds."""
    ok = col.isNotNull()
    if low is not None:
        ok = ok & truth(col >= F.lit(low))
    if high is not None:
        ok = ok & truth(col <= F.lit(high))
    return ok
