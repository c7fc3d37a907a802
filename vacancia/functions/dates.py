"""Date bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def day(value: Column | str) -> Column:
    return F.to_date(as_column(value))


def week_start(value: Column | str) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", as_column(value)))


def week_end(value: Column | str) -> Column:
    """Sunday that closes the week; a Sunday is its own label."""
    return F.next_day(F.date_sub(day(value), 1), "SUN")
