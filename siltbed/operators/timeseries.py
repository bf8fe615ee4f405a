"""Per-key ordered series: daily bars, gap filling, moving features, running products.

The windowed operators exist for two situations.

* ``slice_by=None``: each key has been reduced to a bounded grain (daily bars, one row per
  year), so one window per key is small by construction.
* ``slice_by=<expression growing with the order column>``: rows per key are unbounded and one
  key may hold a large part of the table. The window then runs per (key, slice) over rows
  extended by the few rows (or the one product) that reach in from earlier slices. Those
  come from a per-slice table: a key costs one task ``depth`` rows per slice, not all rows.

Results are the same in both. Slices should be short enough for a task and long enough that
a key has far fewer slices than rows, e.g. a month of daily rows or an hour of ticks. Where no
such expression bounds a slice, :func:`range_sliced` cuts the table by size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.functions import clip, safe_ratio, zero_to_null
from siltbed.sources.session import staged

_SLICE = "_slice"
_REACHING = "_reaching"


def range_sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "range_slice"
) -> DataFrame:
    """Cut the table into even ranges of (keys, order), numbered in ``out`` for ``slice_by``.

    Range partitioning samples the data, so a hot key gets as many slices as its size asks
    for, whatever its distribution. The numbering is staged: limits sampled anew would not
    be the same twice.
    """
    return staged(df.repartitionByRange(*keys, *order).withColumn(out, F.spark_partition_id()))


def _sorted(columns: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c in columns]


def _extended(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    depth: int,
    columns: Sequence[str],
    fill: bool,
    descending: bool = False,
) -> DataFrame:
    """Rows with their slice, plus copies of the ``depth`` rows before each slice.

    Copies are marked in ``_reaching``, hold only order and ``columns``, and sort before
    the slice's own rows. With ``fill`` their gaps are already filled forward, so the last
    copy carries the value that reaches into the slice. ``descending`` turns the order
    round: "before" then means the later slices.
    """
    sliced = df.withColumn(_SLICE, slice_by)
    narrow = sliced.select(*dict.fromkeys([*keys, _SLICE, *order, *columns]))
    inside = W.partitionBy(*keys, _SLICE)
    if fill:
        forwards = inside.orderBy(*_sorted(order, descending))
        upto = forwards.rowsBetween(W.unboundedPreceding, 0)
        ends = narrow.withColumns(
            {c: F.last(c, ignorenulls=True).over(upto) for c in columns}
            | {
                "_place": F.row_number().over(forwards),
                "_size": F.count(F.lit(1)).over(inside),
            }
        ).withColumn("_back", F.col("_size") - F.col("_place") + 1)
    else:
        # Spark prunes to the last rows of each slice before the shuffle.
        ends = narrow.withColumn(
            "_back", F.row_number().over(inside.orderBy(*_sorted(order, not descending)))
        )
    along = W.partitionBy(*keys).orderBy(*_sorted([_SLICE], descending), F.desc("_back"))
    ends = ends.filter(F.col("_back") <= depth)
    if fill:
        before = along.rowsBetween(W.unboundedPreceding, 0)
        ends = ends.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in columns})
    copied = [c for c in dict.fromkeys([*order, *columns]) if c not in keys]
    previous = F.collect_list(F.struct(*copied)).over(along.rowsBetween(-depth, -1))
    opens_slice = F.row_number().over(inside.orderBy(F.desc("_back"))) == 1
    reaching = (
        ends.withColumns({"_previous": previous, "_opens": opens_slice})
        .filter("_opens")
        .select(*keys, _SLICE, F.inline("_previous"))
    )
    return sliced.withColumn(_REACHING, F.lit(False)).unionByName(
        reaching.withColumn(_REACHING, F.lit(True)), allowMissingColumns=True
    )


def _own_rows(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(_REACHING)).drop(_SLICE, _REACHING)


def daily_bars(
    df: DataFrame, key: str, ts: str, value: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Open, high, low, close and volume per key and day.

    Aggregated with map-side combine: a hot key sends one row per day and task. Where
    ``ts`` is not unique per key, ``tie_break`` fixes which row opens and closes the day.
    """
    when = F.struct(ts, *tie_break) if tie_break else F.col(ts)
    return (
        df.withColumn("date", F.col(ts).cast("date"))
        .groupBy(key, "date")
        .agg(
            F.min_by(value, when).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, when).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    slice_by: Column | None = None,
    descending: bool = False,
) -> DataFrame:
    """Replace NULLs by the last value before them in the key's order.

    With ``descending`` the order is turned round, which fills backwards.
    """
    if slice_by is not None:
        extended = _extended(df, keys, order, slice_by, 1, columns, True, descending)
        return _own_rows(
            forward_fill(extended, [*keys, _SLICE], order, columns, descending=descending)
        )
    w = W.partitionBy(*keys).orderBy(*_sorted(order, descending))
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})


def previous_values(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    slice_by: Column | None = None,
) -> DataFrame:
    """Add ``{new column: column}`` holding the value of the row before."""
    if slice_by is not None:
        extended = _extended(df, keys, order, slice_by, 1, [*columns.values()], fill=False)
        return _own_rows(previous_values(extended, [*keys, _SLICE], order, columns))
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(c).over(w) for new, c in columns.items()})


def moving_averages(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    spans: Mapping[str, int],
    slice_by: Column | None = None,
) -> DataFrame:
    """Trailing averages over the given numbers of rows; shorter at the start of a key."""
    if slice_by is not None:
        depth = max(spans.values()) - 1
        extended = _extended(df, keys, order, slice_by, depth, [column], fill=False)
        return _own_rows(moving_averages(extended, [*keys, _SLICE], order, column, spans))
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumns(
        {name: F.avg(column).over(w.rowsBetween(1 - n, 0)) for name, n in spans.items()}
    )


def technical_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    spans: Mapping[str, int] | None = None,
    slice_by: Column | None = None,
) -> DataFrame:
    """Clean an OHLCV series and add returns, range and moving averages.

    Zero closes and volumes count as missing and are filled forward; ratios with a zero
    denominator are NULL. All windows share one shuffle and one sort.
    """
    spans = spans or {"ma_5": 5, "ma_20": 20}
    gappy = ["close", "volume"]
    series = df.withColumns({c: zero_to_null(F.col(c)) for c in gappy})
    if slice_by is not None:
        depth = max(spans.values()) - 1
        extended = _extended(series, keys, order, slice_by, depth, gappy, fill=True)
        return _own_rows(technical_features(extended, [*keys, _SLICE], order, spans))
    filled = forward_fill(series, keys, order, gappy)
    featured = filled.withColumns(
        {
            "daily_return": safe_ratio(F.col("close") - F.col("open"), F.col("open")),
            "volatility_range": safe_ratio(F.col("high") - F.col("low"), F.col("close")),
        }
    )
    return moving_averages(featured, keys, order, "close", spans)


def percent_change(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str
) -> DataFrame:
    """Change against the previous row after forward filling; 0 for the first row.

    Meant for series of bounded length, such as the years of a forecast.
    """
    filled = forward_fill(df.withColumn("_filled", F.col(column)), keys, order, ["_filled"])
    paired = previous_values(filled, keys, order, {"_before": "_filled"})
    change = safe_ratio(F.col("_filled") - F.col("_before"), F.col("_before"))
    return paired.withColumn(out, F.coalesce(change, F.lit(0.0))).drop("_filled", "_before")


def running_product(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rate: str,
    start: Column,
    out: str,
    bounds: tuple[float, float] | None = (0.5, 1.8),
    slice_by: Column | None = None,
) -> DataFrame:
    """``start`` compounded by ``1 + rate`` along the order, optionally clipped.

    ``bounds`` are multiples of ``start``; the clip applies to the reported value only, not
    to the running product.
    """
    parts = df.withColumn("_growth", 1 + F.col(rate))
    group = list(keys)
    if slice_by is not None:
        # One extra row per slice holds the product of all earlier slices; its NULL order
        # columns sort first.
        sliced = parts.withColumn(_SLICE, slice_by)
        before = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
        reaching = (
            sliced.groupBy(*keys, _SLICE)
            .agg(F.product("_growth").alias("_whole"))
            .select(*keys, _SLICE, F.product("_whole").over(before).alias("_growth"))
            .filter(F.col("_growth").isNotNull())
        )
        parts = sliced.withColumn(_REACHING, F.lit(False)).unionByName(
            reaching.withColumn(_REACHING, F.lit(True)), allowMissingColumns=True
        )
        group.append(_SLICE)
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    factored = parts.withColumn("_factor", F.product("_growth").over(w))
    if slice_by is not None:
        factored = _own_rows(factored)
    value = start * F.col("_factor")
    if bounds:
        value = clip(value, start * bounds[0], start * bounds[1])
    return factored.withColumn(out, value).select(*df.columns, out)
