"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def safe_double(c: Column) -> Column:
    """Number or number text to DOUBLE; unparseable text and NaN become NULL."""
    return nan_to_null(c.try_cast("double"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL for a zero denominator."""
    return F.when(denominator != 0, numerator / denominator)


def clip(c: Column, low: Column | float, high: Column | float) -> Column:
    """Limit to ``[low, high]``; NULL stays NULL although ``least``/``greatest`` skip NULLs."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))
