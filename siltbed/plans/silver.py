"""Bronze to silver: cleaning recipes and the job around them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import (
    canonical_unit,
    normalise_text,
    parse_price,
    safe_date,
    strip_unit_suffix,
)
from siltbed.operators.intervals import explode_daily, validity_intervals
from siltbed.operators.projection import normalise_strings, safe_cast, standardise_names
from siltbed.operators.quality import dedupe_rows, drop_all_null, flag_and_cap, require
from siltbed.operators.steps import NoLog, Step, StepLog, count_steps, step_table
from siltbed.operators.timeseries import technical_features
from siltbed.plans import fixed_values as fixed
from siltbed.sources.readers import read_table
from siltbed.sources.session import staged
from siltbed.sources.writers import WriteResult, write_table

Recipe = Callable[[DataFrame, StepLog], DataFrame]


#: Where the step report lies in a lake.
STEP_REPORT = "quality/silver_steps"


@dataclass(frozen=True)
class SilverResult:
    """Row counts around a silver job, and what each of its steps did."""

    rows_in: int
    written: WriteResult
    steps: list[Step]

    @property
    def delta(self) -> int:
        return self.written.rows - self.rows_in


def clean_panel(
    df: DataFrame,
    schema: Mapping[str, str],
    outlier_columns: Sequence[str] = (),
    unit_suffixes: Mapping[str, str] | None = None,
    k: float = fixed.OUTLIER_STDDEVS,
    log: StepLog | None = None,
) -> DataFrame:
    """Names, units, types, strings, outliers, empty rows, duplicates - in that order."""
    log = log or NoLog()
    named = log.start(standardise_names(df))
    suffixes = {c: u for c, u in (unit_suffixes or {}).items() if c in named.columns}
    units = {c: strip_unit_suffix(F.col(c), u) for c, u in suffixes.items()}
    out = log.step(named, "units", lambda d: d.withColumns(units)) if units else named
    out = log.step(out, "types", safe_cast, schema)
    out = log.step(out, "strings", normalise_strings)
    out = log.step(out, "outliers", flag_and_cap, outlier_columns, k)
    out = log.step(out, "empty_rows", drop_all_null)
    return log.step(out, "duplicates", dedupe_rows)


def clean_bars(
    df: DataFrame,
    key: str = "ticker",
    date: str = "date",
    spans: Mapping[str, int] | None = None,
    slice_unit: str | None = "month",
    log: StepLog | None = None,
) -> DataFrame:
    """Daily bars: types, duplicates, gaps, features; rows without key or date are dropped.

    The windows run per key and calendar month by default, so one ticker with a large part
    of the table is spread over the cluster. ``slice_unit=None`` uses one window per key.
    """
    log = log or NoLog()
    cleaned = log.step(log.start(standardise_names(df)), "dates", lambda d: d.withColumn(date, safe_date(F.col(date))))
    cleaned = log.step(cleaned, "without_key", require, [key, date])
    cleaned = log.step(cleaned, "duplicates", dedupe_rows)
    # Different bars of one day keep one order, whatever the partitioning. Prices and volumes
    # that get filled take part as they were.
    ties = [c for c in ("open", "high", "low", "adj_close") if c in cleaned.columns]
    unfilled = {f"_unfilled_{c}": F.col(c) for c in ("close", "volume") if c in cleaned.columns}
    slice_by = F.trunc(date, slice_unit) if slice_unit else None

    def features(bars: DataFrame) -> DataFrame:
        return technical_features(
            bars.withColumns(unfilled), [key], [date, *ties, *unfilled], spans or fixed.MOVING_AVERAGES, slice_by
        ).drop(*unfilled)

    # The features read their input several times, which would count it as often.
    cleaned = cleaned if isinstance(log, NoLog) else staged(cleaned)
    return log.step(cleaned, "features", features)


def clean_prices(
    df: DataFrame, daily: bool = True, drop_bad_first: bool = False, log: StepLog | None = None
) -> DataFrame:
    """Price observations: text, numbers, units, validity intervals, daily rows.

    An unparseable price ends the interval before it and leaves a gap. With
    ``drop_bad_first`` such rows are ignored from the start, so the earlier price holds on.
    """
    log = log or NoLog()
    fields = [
        safe_date(F.col("date")).alias("report_date"),
        normalise_text(F.col("product")).alias("product"),
        parse_price(F.col("price")).alias("price"),
        canonical_unit(F.col("unit"), fixed.UNIT_VARIANTS).alias("unit"),
        normalise_text(F.col("category")).alias("category"),
    ]
    bounds = "price_effective_date", "price_expiration_date"
    named = standardise_names(df)
    # Read twice, so not observed: the last day of all observations.
    last_day = named.agg(F.max(safe_date(F.col("date")))).scalar() if not drop_bad_first else (
        named.where(parse_price(F.col("price")).isNotNull()).agg(F.max(safe_date(F.col("date")))).scalar()
    )
    out = log.step(log.start(named), "parse", lambda d: d.select(*fields), renamed={"date": "report_date"})
    if drop_bad_first:
        out = log.step(out, "bad_prices", require, ["price"])
    out = log.step(out, "intervals", validity_intervals, ["product", "category"], "report_date", "price", *bounds)
    if daily:
        out = log.step(out, "days", explode_daily, *bounds, "date", last_day)
    out = log.step(out, "empty_rows", drop_all_null)
    return log.step(out, "without_price", require, ["price"])


def silver_job(
    spark: SparkSession,
    source: str,
    target: str,
    recipe: Recipe,
    partition_by: Sequence[str] = (),
) -> SilverResult:
    """Read a bronze table, apply the recipe, write silver.

    Nothing is cached: rows and steps are counted while the output is written, and the input
    count reads no column of the parquet files. Steps that do not agree with the counts of
    the two tables, as some tasks ran twice, are counted again.
    """
    bronze, log = read_table(spark, source), StepLog()
    written, rows_in = write_table(recipe(bronze, log), target, partition_by), bronze.count()
    steps = log.steps() if log.checked(rows_in, written.rows) else count_steps(bronze, recipe)
    return SilverResult(rows_in, written, steps)


def write_step_report(spark: SparkSession, lake: str, results: Mapping[str, SilverResult]) -> WriteResult:
    """What every step of every job did, as one table beside the silver tables."""
    return write_table(step_table(spark, {name: r.steps for name, r in results.items()}), f"{lake}/{STEP_REPORT}")


def panel_recipe(dataset: str) -> Recipe:
    return lambda df, log: clean_panel(
        df,
        fixed.PANEL_SCHEMAS[dataset],
        fixed.PANEL_OUTLIERS[dataset],
        fixed.PANEL_UNIT_SUFFIXES.get(dataset),
        log=log,
    )


def silver_panels(spark: SparkSession, lake: str) -> dict[str, SilverResult]:
    return {
        name: silver_job(
            spark,
            f"{lake}/{fixed.BRONZE_PANELS}/{name}",
            f"{lake}/{fixed.SILVER_PANELS}/{name}",
            panel_recipe(name),
        )
        for name in fixed.PANEL_SCHEMAS
    }


def silver_bars(spark: SparkSession, lake: str) -> SilverResult:
    return silver_job(
        spark,
        f"{lake}/{fixed.BRONZE_BARS}",
        f"{lake}/{fixed.SILVER_BARS}",
        lambda df, log: clean_bars(df, log=log),
        ["ticker"],
    )


def silver_prices(spark: SparkSession, lake: str, daily: bool = True) -> SilverResult:
    return silver_job(
        spark,
        f"{lake}/{fixed.BRONZE_PRICES}",
        f"{lake}/{fixed.SILVER_PRICES}",
        lambda df, log: clean_prices(df, daily, log=log),
    )
