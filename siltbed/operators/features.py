"""Panel features: imputation, lags, growth, category codes, time-based splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.functions import clip, safe_double
from siltbed.operators.projection import with_missing
from siltbed.operators.quality import dedupe_by_key
from siltbed.operators.quantiles import exact_medians
from siltbed.operators.timeseries import forward_fill, previous_values
from siltbed.sources.session import staged


def numeric_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add absent feature columns and coerce all of them to DOUBLE."""
    full = with_missing(df, columns)
    return full.withColumns({c: safe_double(F.col(c)) for c in columns})


def impute_medians(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill by the key's median, then the median over all filled rows, then 0.

    Rows without a key belong to no group: they take the overall median even where they had
    a value. The panel is read in several passes: stage it first. Its medians per key are
    staged here.
    """
    by_key = staged(exact_medians(df, columns, [key]))
    side = by_key.select(F.col(key).alias("_key"), F.struct(*columns).alias("_median"))
    grouped = (
        df.join(side, F.col(key) == F.col("_key"), "left")
        .withColumns(
            {
                c: F.when(F.col(key).isNotNull(), F.coalesce(F.col(c), F.col("_median")[c]))
                for c in columns
            }
        )
        .drop("_key", "_median")
    )
    overall = exact_medians(grouped, columns).select(F.struct(*columns)).scalar()
    return grouped.withColumns(
        {c: F.coalesce(F.col(c), overall[c], F.lit(0.0)) for c in columns}
    )


def lag_and_growth(
    df: DataFrame,
    key: str,
    order: str,
    targets: Sequence[str],
    bounds: tuple[float, float] = (-0.5, 1.5),
    slice_by: Column | None = None,
) -> DataFrame:
    """Add ``<target>_lag_1`` and ``<target>_yoy_growth`` per key in order.

    Missing lags are filled from the next one, then from the previous one, then 0; growth is
    0 for a zero lag and clipped otherwise. A panel with one row per key and period has
    windows as long as its periods; for longer ones ``slice_by`` cuts a key into slices.
    Rows without a key form no series: they are spread over many windows, get no lag and
    zero growth. The explicit shuffle keeps an earlier partitioning by the key alone from
    gathering them again.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*df.columns))
    # Rows of one key and period keep one order, whatever the partitioning.
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    spaced = tied.withColumn("_spread", spread).repartition(key, "_spread")
    keys, lags = [key, "_spread"], {f"{t}_lag_1": t for t in targets}
    lagged = (
        spaced.transform(previous_values, keys, [order, "_tie"], lags, slice_by)
        .transform(forward_fill, keys, [order, "_tie"], list(lags), slice_by, descending=True)
        .transform(forward_fill, keys, [order, "_tie"], list(lags), slice_by)
        .withColumns(
            {c: F.when(F.col(key).isNotNull(), F.coalesce(F.col(c), F.lit(0.0))) for c in lags}
        )
    )

    def growth(t: str) -> Column:
        lag = F.col(f"{t}_lag_1")
        change = F.when(lag != 0, (F.col(t) - lag) / lag)
        return F.coalesce(clip(change, *bounds), F.lit(0.0))

    return lagged.withColumns({f"{t}_yoy_growth": growth(t) for t in targets}).drop("_spread", "_tie")


def ordinals(df: DataFrame, column: str, slices: int = 256) -> DataFrame:
    """(_v, _code): the distinct values that are not NULL and their places in order, from 0.

    Counting runs per slice of the sorted values. The about ``slices`` slice limits are a
    hash sample of the distinct values, so they depend on the data only and need no driver
    round trip.
    """
    values = df.select(F.col(column).alias("_v")).dropna().distinct()
    members = df.agg(F.approx_count_distinct(column)).scalar()
    one_in = F.greatest(F.lit(1), (members / slices).cast("bigint"))
    limits = values.filter(F.pmod(F.xxhash64("_v"), one_in) == 0).agg(
        F.array_sort(F.collect_list("_v"))
    )
    # Never NULL, so no NULL check on it is pushed down to the rows before the distinct.
    passed = F.coalesce(F.size(F.filter("_limits", lambda x: x <= F.col("_v"))), F.lit(0))
    sliced = values.withColumn("_limits", limits.scalar()).select("_v", passed.alias("_s"))
    before = F.sum("_n").over(W.orderBy("_s").rowsBetween(W.unboundedPreceding, -1))
    starts = (
        sliced.groupBy("_s")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_s", F.coalesce(before, F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(W.partitionBy("_s").orderBy("_v")) - 1
    return sliced.join(starts, "_s").select("_v", (F.col("_start") + within).alias("_code"))


def category_codes(df: DataFrame, column: str, out: str, slices: int = 256) -> DataFrame:
    """Ordinal code of each value among the sorted distinct values; -1 for NULL."""
    codes = ordinals(df, column, slices).select("_v", F.col("_code").cast("int").alias(out))
    coded = df.drop(out).join(codes, F.col(column) == F.col("_v"), "left").drop("_v")
    return coded.withColumn(out, F.coalesce(out, F.lit(-1)))


def chronological_split(
    df: DataFrame, period: str, test_fraction: float = 0.2, out: str = "is_train"
) -> DataFrame:
    """Mark the earlier periods as training rows.

    The cut counts distinct periods; with at least two, both sides get one. Periods are
    numbered in slices and never gathered, and rows are not shuffled. The panel is read
    several times: stage it first where computing it is dear.
    """
    n = df.agg(F.count_distinct(period)).scalar()
    cut = F.floor(n * (1 - test_fraction))
    cut = F.greatest(F.lit(1), F.least(cut, n - 1))
    first_test = ordinals(df, period).filter(F.col("_code") == cut).agg(F.min("_v")).scalar()
    early = F.coalesce(F.col(period) < first_test, F.lit(True))
    return df.withColumn(out, F.when(F.col(period).isNotNull(), early))


def latest_snapshot(
    df: DataFrame, key: str, period: str, targets: Sequence[str] = ()
) -> DataFrame:
    """One row per key in the table's latest period, with each lag set to the current value.

    The panel is read twice: stage it first where computing it is dear.
    """
    latest = df.filter(F.col(period) == df.agg(F.max(period)).scalar())
    current = {f"{t}_lag_1": F.col(t) for t in targets}
    return dedupe_by_key(latest.withColumns(current), [key])
