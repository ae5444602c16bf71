"""Dates: strict parsing, Monday weeks, reference months, month names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as printed.
MONTH_NAMES = [
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]


def safe_date(text: str | Column) -> Column:
    """``yyyyMMdd`` text to a date; anything else, ``00000000`` included, is NULL."""
    return F.try_to_date(F.col(text) if isinstance(text, str) else text, "yyyyMMdd")


def date_text(day: dt.date) -> str:
    return day.strftime("%Y%m%d")


def week_start(day: str | Column) -> Column:
    return F.trunc(day, "week")


def is_partial_week(week: str | Column, extraction: Column) -> Column:
    """A week whose Sunday lies beyond the extraction is cut in the middle."""
    return F.date_add(week, 6) > extraction


def in_month(week: str | Column, month: dt.date) -> Column:
    """Weeks that begin in ``month``, as a range so that it reaches the file scan."""
    week = F.col(week) if isinstance(week, str) else week
    return (week >= F.lit(month)) & (week < F.lit(next_month(month)))


def next_month(month: dt.date) -> dt.date:
    return (month.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def previous_month(month: dt.date) -> dt.date:
    return (month.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def reference_month(extraction: dt.date) -> dt.date:
    """First day of the last calendar month closed before the extraction."""
    return previous_month(extraction)


def reference_month_col(extraction: str | Column) -> Column:
    return F.add_months(F.trunc(extraction, "month"), -1)


def month_label(month: str | Column) -> Column:
    """``junho/2026`` for any day of June 2026."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    return F.concat(F.element_at(names, F.month(month)), F.lit("/"), F.year(month).cast("string"))
