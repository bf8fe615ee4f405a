"""Quality filters, duplicate removal, outlier capping and one-pass quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from siltbed.functions import nan_to_null, safe_date
from siltbed.operators.quantiles import exact_percentiles


# ---- filters -----------------------------------------------------------------------------


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which every given column is present."""
    return df.dropna(how="any", subset=list(columns))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns], F.lit(False))


# ---- duplicates --------------------------------------------------------------------------


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop identical rows. Copies collapse map-side, so a hot row never reaches one task."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by all other columns.

    The survivor does not depend on partitioning, and an aggregate with map-side
    combine replaces a window that would gather whole groups.
    """
    rest = [c for c in dict.fromkeys([*prefer, *df.columns]) if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


# ---- outliers ----------------------------------------------------------------------------


def flag_and_cap(df: DataFrame, columns: Sequence[str], k: float = 3.0) -> DataFrame:
    """Flag values outside mean ± k·stddev in ``<col>_is_outlier`` and cap them to the bounds.

    All bounds come from one aggregate, used as a one-row scalar subquery. A column
    without spread (or with fewer than two values) gets a false flag and stays as it is.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    clean = df.withColumns({c: nan_to_null(F.col(c)) for c in columns})
    stats = clean.agg(
        *[
            F.struct(
                (F.avg(c) - k * F.stddev_samp(c)).alias("low"),
                (F.avg(c) + k * F.stddev_samp(c)).alias("high"),
            ).alias(c)
            for c in columns
        ]
    )
    bounds = stats.select(F.struct(*columns)).scalar()

    def rule(c: str) -> tuple[Column, Column]:
        low, high = bounds[c]["low"], bounds[c]["high"]
        spread = F.coalesce(low < high, F.lit(False))
        outside = F.when(
            F.col(c).isNotNull(), spread & ((F.col(c) < low) | (F.col(c) > high))
        )
        capped = F.when(outside, F.greatest(low, F.least(high, F.col(c)))).otherwise(F.col(c))
        return outside, capped

    rules = {c: rule(c) for c in columns}
    return clean.withColumns(
        {f"{c}_is_outlier": outside for c, (outside, _) in rules.items()}
        | {c: capped for c, (_, capped) in rules.items()}
    )


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows flagged by :func:`flag_and_cap`."""
    return df.filter(F.col(f"{column}_is_outlier"))


# ---- reports -----------------------------------------------------------------------------


def grain_check(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct grain rows, surplus rows on the grain."""
    per_grain = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
    return per_grain.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_grain_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_grain_rows"))


def null_fk_report(df: DataFrame, foreign_keys: Sequence[str]) -> DataFrame:
    """One row: total rows, rows with any NULL foreign key, percentage."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(any_null(foreign_keys)).alias("null_fk_rows"),
    ).withColumn(
        "null_pct",
        F.when(F.col("total_rows") > 0, F.col("null_fk_rows") * 100.0 / F.col("total_rows"))
        .otherwise(F.lit(0.0)),
    )


def null_fk_rows(df: DataFrame, foreign_keys: Sequence[str]) -> DataFrame:
    """The rows counted by :func:`null_fk_report`; take a ``limit`` of them to look at."""
    return df.filter(any_null(foreign_keys))


def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with the counts around a step: removed, added or unchanged."""
    counts = before.agg(F.count(F.lit(1)).alias("rows_before")).withColumn(
        "rows_after", after.agg(F.count(F.lit(1))).scalar()
    )
    delta = F.col("rows_after") - F.col("rows_before")
    return counts.withColumns(
        {
            "delta": delta,
            "change": F.when(delta < 0, "removed").when(delta > 0, "added").otherwise("unchanged"),
        }
    )


def column_gaps(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Missing and unexpected column names (metadata only)."""
    return {
        "missing": sorted(set(expected) - set(df.columns)),
        "unexpected": sorted(set(df.columns) - set(expected)),
    }


def type_gaps(df: DataFrame, expected: Mapping[str, DataType]) -> dict[str, str]:
    """Columns whose type differs from the expected one (metadata only)."""
    actual = {f.name: f.dataType for f in df.schema}
    return {
        c: f"expected={t} actual={actual[c]}"
        for c, t in expected.items()
        if c in actual and actual[c] != t
    }


def validation_report(
    df: DataFrame,
    source_name: str,
    expected_columns: Sequence[str] = (),
    expected_types: Mapping[str, DataType] | None = None,
    date_column: str | None = None,
    count_duplicates: bool = True,
) -> DataFrame:
    """One-row report: counts, NULLs per column, duplicates, bad dates, schema gaps, verdict.

    Everything is one aggregate. With ``count_duplicates`` the rows are first grouped by
    all columns (copies combine map-side) and the counts are weighted by group size;
    without it no row is shuffled.
    """
    gaps = column_gaps(df, expected_columns) if expected_columns else {"missing": [], "unexpected": []}
    mismatches = type_gaps(df, expected_types or {})
    issues = []
    if gaps["missing"]:
        issues.append(f"missing expected columns: {gaps['missing']}")
    if mismatches:
        issues.append(f"type mismatches: {mismatches}")

    if count_duplicates:
        rows, weight = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")), F.col("_copies")
    else:
        rows, weight = df, F.lit(1)

    def tally(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")

    bad_date = (
        F.col(date_column).isNotNull() & safe_date(F.col(date_column)).isNull()
        if date_column
        else F.lit(None).cast("boolean")
    )
    report = rows.agg(
        tally(F.lit(True)).alias("row_count"),
        *([tally(F.lit(True)) - F.count(F.lit(1))] if count_duplicates else [F.lit(None).cast("bigint")]),
        *[tally(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns],
        (tally(bad_date) if date_column else F.lit(None).cast("bigint")).alias("invalid_date_count"),
    )
    report = report.toDF("row_count", "duplicate_row_count", *report.columns[2:])

    def texts(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return report.select(
        F.lit(source_name).alias("source_name"),
        "*",
        (F.col("row_count") == 0).alias("is_empty"),
        texts(gaps["missing"]).alias("missing_columns"),
        texts(gaps["unexpected"]).alias("unexpected_columns"),
        texts([f"{c}: {m}" for c, m in mismatches.items()]).alias("type_mismatches"),
        F.lit(not issues).alias("passed"),
        texts(issues).alias("issues"),
    )


def profile(df: DataFrame, quartiles: bool = True) -> DataFrame:
    """One row per column: count, nulls, min, max and, for numbers, mean, stddev, quartiles.

    A single aggregate over the table. Quartiles are exact: values that occur, at a quarter,
    a half and three quarters of the ranks. They take passes of their own, which run when
    the report is built; without them nothing runs before it is read.
    """
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    found = None
    if quartiles and numbers:
        plain = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(numbers)])
        found = exact_percentiles(plain, plain.columns, [0.25, 0.5, 0.75]).select(F.struct("*")).scalar()
    entries = []
    for f in df.schema:
        c, number = F.col(f"`{f.name}`"), f.name in numbers
        none = F.lit(None).cast("double")
        fields = [
            F.lit(f.name).alias("column_name"),
            F.count(c).alias("count"),
            F.count_if(c.isNull()).alias("nulls"),
            (F.avg(c) if number else none).alias("mean"),
            (F.stddev_samp(c) if number else none).alias("stddev"),
            F.min(c).cast("string").alias("min"),
            F.max(c).cast("string").alias("max"),
        ]
        if quartiles:
            if number:
                i = numbers.index(f.name)
                three = F.array(*[found[f"c{i}_p{p}"] for p in (25, 50, 75)])
                held = F.when(F.count(c) > 0, three)
            else:
                held = F.lit(None).cast("array<double>")
            fields.append(held.alias("quartiles"))
        entries.append(F.struct(*fields))
    return df.agg(F.array(*entries).alias("_columns")).select(F.inline("_columns"))
