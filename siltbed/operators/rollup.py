"""Config-driven rollups and yearly totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

AGGREGATES = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def rollup(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """Group by ``keys`` with one named aggregate per column; absent columns give NULL.

    Call :func:`absent_metrics` to report which ones are absent.
    """
    def metric(c: str, fn: str) -> Column:
        if c in df.columns:
            return AGGREGATES[fn](c).alias(c)
        return F.lit(None).cast("double").alias(c)

    return df.groupBy(*keys).agg(*[metric(c, fn) for c, fn in metrics.items()])


def absent_metrics(df: DataFrame, metrics: Mapping[str, str]) -> list[str]:
    return [c for c in metrics if c not in df.columns]


def average_panel(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Average of every column per key combination."""
    return rollup(df, keys, {c: "avg" for c in columns})


def compound_growth(df: DataFrame, year: str, value: str, out: str = "cagr") -> DataFrame:
    """Compound annual growth against the first year of a yearly table.

    The window has no partition: the input holds one row per year.
    """
    w = W.orderBy(year)
    base = F.first(value).over(w)
    span = F.col(year) - F.first(year).over(w)
    rate = F.pow(F.col(value) / base, 1 / span) - 1
    return df.withColumn(out, F.when((span > 0) & (base != 0), rate).otherwise(F.lit(0.0)))
