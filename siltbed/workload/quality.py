"""Filters, duplicates, outliers and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from siltbed.functions import parse_price
from siltbed.operators import quality as q
from siltbed.operators.dimensional import lookup_key, with_key
from siltbed.operators.quantiles import exact_medians, exact_percentiles
from siltbed.operators.steps import observed_delta
from siltbed.workload.registry import query, rounded, table


def _gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status decides which columns are missing; pending ones miss all."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.when(status != "P", F.col("o_orderkey")).alias("key"),
        F.when(status == "F", F.col("o_orderdate").cast("date")).alias("date"),
        F.when(status != "P", F.col("o_totalprice")).alias("price"),
    )


GAPPY_SQL = """
gappy AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS key,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS date,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
  FROM orders)"""


@query(f"WITH {GAPPY_SQL} SELECT * FROM gappy WHERE key IS NOT NULL OR date IS NOT NULL OR price IS NOT NULL")
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.drop_all_null(_gappy_orders(spark, sf_dir))


@query(f"WITH {GAPPY_SQL} SELECT * FROM gappy WHERE key IS NOT NULL AND date IS NOT NULL")
def require_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.require(_gappy_orders(spark, sf_dir), ["key", "date"])


@query("""
SELECT o_orderkey, round(CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), 2) AS price
FROM orders WHERE o_orderstatus <> 'P'""")
def drop_bad_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose price text does not parse are dropped."""
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.concat(F.lit("$"), amount))
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", parse_price(text).alias("price"))
    return q.require(parsed, ["price"]).withColumn("price", F.round(F.col("price").cast("double"), 2))


@query("SELECT DISTINCT * FROM lineitem")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return q.dedupe_rows(lineitem.unionByName(lineitem))


@query("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_key_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest shipment per order line, ties broken by the other columns."""
    return q.dedupe_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


OUTLIER_SQL = """
stats AS (SELECT avg(value) AS m, 3 * stddev_samp(value) AS d FROM events),
flagged AS (
  SELECT event_id, event_type, value < m - d OR value > m + d AS value_is_outlier,
         round(greatest(m - d, least(m + d, value)), 6) + 0.0 AS value
  FROM events, stats)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rounded(q.flag_and_cap(events, ["value"], 3.0), ["value"])


@query(f"WITH {OUTLIER_SQL} SELECT * FROM flagged")
def outlier_flag_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir)


@query(f"WITH {OUTLIER_SQL} SELECT * FROM flagged WHERE value_is_outlier")
def outlier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.outliers(_flagged(spark, sf_dir), "value")


def _profile_sql(table_name: str, numbers: list[str], texts: list[str], quartiles: bool = False) -> str:
    def three(c: str) -> str:
        parts = [f"quantile_disc(CAST({c} AS DOUBLE), {p / 100}) AS q{p}" if c else f"NULL AS q{p}" for p in (25, 50, 75)]
        return ", " + ", ".join(parts) if quartiles else ""

    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS nulls, "
        f"round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS stddev, "
        f"round(CAST(min({c}) AS DOUBLE), 4) AS min_number, round(CAST(max({c}) AS DOUBLE), 4) AS max_number, "
        f"CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text{three(c)} FROM {table_name}"
        for c in numbers
    ] + [
        f"SELECT '{c}', count({c}), count(*) - count({c}), NULL, NULL, NULL, NULL, CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR){three('')} "
        f"FROM {table_name}"
        for c in texts
    ]
    return " UNION ALL ".join(parts)


@query(
    _profile_sql(
        "orders",
        ["o_orderkey", "o_custkey", "o_totalprice"],
        ["o_orderstatus", "o_orderdate", "o_orderpriority"],
    )
)
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, NULLs, mean, spread and extremes of every column in one pass."""
    return _summary(q.profile(table(spark, sf_dir, "orders"), quartiles=False))


def _summary(stats: DataFrame, *more: Column) -> DataFrame:
    """Extremes of numbers and of other columns apart, rounded."""
    number = F.col("mean").isNotNull()
    return stats.select(
        "column_name",
        "count",
        "nulls",
        (F.round("mean", 4) + 0.0).alias("mean"),
        (F.round("stddev", 4) + 0.0).alias("stddev"),
        *[
            F.round(F.when(number, F.col(c).try_cast("double")), 4).alias(f"{c}_number")
            for c in ("min", "max")
        ],
        *[F.when(~number, F.col(c)).alias(f"{c}_text") for c in ("min", "max")],
        *more,
    )


@query(
    _profile_sql(
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["l_returnflag", "l_linestatus", "l_shipdate"],
        quartiles=True,
    ),
    name="profile_quartile_sketches",
)
def profile_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile with exact quartiles, which took the place of sketches under the same name."""
    quartiles = [F.get("quartiles", i).alias(f"q{p}") for i, p in enumerate((25, 50, 75))]
    return _summary(q.profile(table(spark, sf_dir, "lineitem")), *quartiles)


@query("""
SELECT l_returnflag,
       quantile_disc(l_extendedprice, 0.25) AS "l_extendedprice_p25",
       quantile_disc(l_extendedprice, 0.5) AS "l_extendedprice_p50",
       quantile_disc(l_extendedprice, 0.75) AS "l_extendedprice_p75",
       quantile_disc(l_quantity, 0.25) AS "l_quantity_p25",
       quantile_disc(l_quantity, 0.5) AS "l_quantity_p50",
       quantile_disc(l_quantity, 0.75) AS "l_quantity_p75"
FROM lineitem GROUP BY l_returnflag""")
def exact_quartiles_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of three groups that hold a third of the rows each."""
    return exact_percentiles(
        table(spark, sf_dir, "lineitem"),
        ["l_extendedprice", "l_quantity"],
        [0.25, 0.5, 0.75],
        ["l_returnflag"],
    )


@query("""
SELECT l_returnflag, round(median(l_extendedprice), 6) AS l_extendedprice,
       round(median(l_discount), 6) AS l_discount
FROM lineitem GROUP BY l_returnflag""")
def exact_median_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_extendedprice", "l_discount"]
    return rounded(exact_medians(table(spark, sf_dir, "lineitem"), columns, ["l_returnflag"]), columns)


@query("""
WITH o AS (
  SELECT nullif(o_orderpriority, '5-LOW') AS priority,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price
  FROM orders)
SELECT priority, round(median(price), 6) AS price FROM o GROUP BY priority""")
def exact_median_null_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians with a NULL group and a group without any value."""
    priority = F.col("o_orderpriority")
    orders = table(spark, sf_dir, "orders").select(
        F.nullif(priority, F.lit("5-LOW")).alias("priority"),
        F.when(priority != "1-URGENT", F.col("o_totalprice")).alias("price"),
    )
    return rounded(exact_medians(orders, ["price"], ["priority"]), ["price"])


@query("""
WITH raw AS (
  SELECT o_custkey AS key,
         CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
           WHEN 'O' THEN 'soon' END AS date,
         CASE WHEN o_orderstatus = 'F' THEN 1.0 END AS price
  FROM orders)
SELECT 'orders' AS source_name, count(*) AS row_count,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicate_row_count,
       count(*) - count(key) AS nulls_key, count(*) - count(date) AS nulls_date,
       count(*) - count(price) AS nulls_price, count_if(date = 'soon') AS invalid_date_count,
       count(*) = 0 AS is_empty, 'status' AS missing_columns, 'price' AS unexpected_columns,
       1 AS type_mismatches, FALSE AS passed, 2 AS issues
FROM raw""", name="validation_report")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, duplicates, NULLs, bad dates and schema gaps in one report."""
    status = F.col("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"),
        F.when(status == "F", F.col("o_orderdate").cast("date").cast("string"))
        .when(status == "O", "soon")
        .alias("date"),
        F.when(status == "F", 1.0).alias("price"),
    )
    report = q.validation_report(
        raw,
        "orders",
        expected_columns=["key", "date", "status"],
        expected_types={"key": LongType(), "date": StringType(), "price": StringType(), "tax": DoubleType()},
        date_column="date",
    )
    return report.withColumns(
        {
            "missing_columns": F.concat_ws(",", "missing_columns"),
            "unexpected_columns": F.concat_ws(",", "unexpected_columns"),
            "type_mismatches": F.size("type_mismatches"),
            "issues": F.size("issues"),
        }
    )


@query("""
SELECT count(*) AS total_rows,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_grain_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows
FROM lineitem""")
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.grain_check(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the key of a customer in good standing and of a settled status."""
    customers = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey")
    dim = with_key(customers, "customer_key", ["c_custkey"])
    facts = lookup_key(table(spark, sf_dir, "orders"), dim, {"o_custkey": "c_custkey"}, "customer_key")
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return facts.withColumn("status_key", settled)


@query("""
SELECT count(*) AS total_rows, count_if(c_custkey IS NULL OR o_orderstatus = 'P') AS null_fk_rows,
       round(100.0 * count_if(c_custkey IS NULL OR o_orderstatus = 'P') / count(*), 6) AS null_pct
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def null_fk_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = q.null_fk_report(_keyed_orders(spark, sf_dir), ["customer_key", "status_key"])
    return rounded(report, ["null_pct"])


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status_key
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
WHERE c_custkey IS NULL OR o_orderstatus = 'P'""")
def null_fk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q.null_fk_rows(_keyed_orders(spark, sf_dir), ["customer_key", "status_key"])
    return rows.select("o_orderkey", "o_custkey", "status_key")


@query("""
SELECT count(*) AS rows_before, count_if(o_orderstatus <> 'P') AS rows_after,
       count_if(o_orderstatus <> 'P') - count(*) AS delta, 'removed' AS change FROM orders""")
def row_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_delta(_gappy_orders(spark, sf_dir), "empty_rows", q.drop_all_null)
