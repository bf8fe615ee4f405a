"""Dates that never fail a job, and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_date(c: Column) -> Column:
    """Date from a date, timestamp or text (also with time and zone); malformed text is NULL."""
    return c.try_cast("date")


def year_or_date(c: Column) -> Column:
    """A four-character value is a year and maps to its first day; anything else is a date."""
    text = c.cast("string")
    return safe_date(F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01"))).otherwise(text))


def calendar_parts(date: str) -> dict[str, Column]:
    """Attributes of a calendar dimension; ``week_number`` is the ISO week."""
    return {
        "day": F.dayofmonth(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "week_number": F.weekofyear(date),
    }
