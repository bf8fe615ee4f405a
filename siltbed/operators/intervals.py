"""Irregular observations to validity intervals, and intervals to a daily grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def validity_intervals(
    df: DataFrame,
    keys: Sequence[str],
    observed: str,
    measure: str,
    effective: str = "effective_date",
    expiration: str = "expiration_date",
) -> DataFrame:
    """Each observation holds until the day before the key's next one; the last stays open.

    Several observations of a key on one day collapse first to the one with the largest
    measure. That keeps intervals disjoint and bounds a key to one row per day before the
    window, however many raw rows it has.
    """
    rest = [c for c in df.columns if c not in (*keys, observed, measure)]
    per_day = (
        df.groupBy(*keys, observed)
        .agg(F.max(F.struct(measure, *rest)).alias("_pick"))
        .select(*keys, observed, "_pick.*")
    )
    following = F.lead(observed).over(W.partitionBy(*keys).orderBy(observed))
    return per_day.select(
        *df.columns,
        F.col(observed).alias(effective),
        F.date_sub(following, 1).alias(expiration),
    )


def explode_daily(
    df: DataFrame,
    effective: str = "effective_date",
    expiration: str = "expiration_date",
    out: str = "date",
    last_day: Column | None = None,
) -> DataFrame:
    """One row per day of each interval; open intervals end at ``last_day``.

    ``last_day`` defaults to the latest effective date, as a scalar subquery. Pass it from
    the raw observations where that is cheaper than from the intervals.
    """
    if last_day is None:
        last_day = df.agg(F.max(effective)).scalar()
    end = F.coalesce(F.col(expiration), last_day)
    days = F.when(F.col(effective) <= end, F.sequence(F.col(effective), end))
    return df.withColumn(out, F.explode(days))
