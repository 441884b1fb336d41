"""Day arithmetic on ``YYYY-MM-DD`` text. The run day is always given, never read from a clock."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def shift_day(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def window_dates(as_of: str, first: int, last: int) -> tuple[str, str]:
    """Both ends, inclusive, of the days ``as_of + first`` to ``as_of + last``."""
    return shift_day(as_of, first), shift_day(as_of, last)


def in_window(dt: Column, as_of: str, first: int, last: int) -> Column:
    """``dt`` lies in the window. The bounds are literals, so partitions are pruned by it."""
    return dt.between(*window_dates(as_of, first, last))


def next_day(dt: Column) -> Column:
    return F.date_format(F.date_add(F.to_date(dt), 1), "yyyy-MM-dd")
