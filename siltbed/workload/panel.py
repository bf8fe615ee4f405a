"""Annual panels: assembly, imputation, lags, codes, splits, snapshots, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.features import (
    category_codes,
    chronological_split,
    impute_medians,
    lag_and_growth,
    latest_snapshot,
    numeric_features,
)
from siltbed.operators.metrics import regression_metrics
from siltbed.operators.projection import select_once
from siltbed.operators.quality import require
from siltbed.sources.session import staged
from siltbed.workload.registry import query, rounded, table

TARGETS = ["order_value", "order_count"]
EXOGENOUS = ["avg_balance", "avg_quantity", "avg_discount"]

# Nation x year: orders by the customer's nation (unknown for customers in debt) beside the
# averages of what the nation's suppliers shipped that year. Low averages count as missing.
PANEL_SQL = """
demand AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation_key,
         CAST(year(o_orderdate) AS INT) AS year, round(sum(o_totalprice), 2) AS order_value,
         CAST(count(*) AS DOUBLE) AS order_count, round(sum(c_acctbal), 2) / count(*) AS avg_balance
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
production AS (
  SELECT s_nationkey AS nation_key, CAST(year(l_shipdate) AS INT) AS year,
         round(sum(l_quantity), 2) / count(*) AS avg_quantity,
         round(sum(l_discount), 2) / count(*) AS avg_discount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
panel AS (
  SELECT d.nation_key, n_name AS nation_name, d.year,
         CASE WHEN avg_balance >= 4800 THEN avg_balance END AS avg_balance,
         CASE WHEN avg_quantity >= 25 THEN avg_quantity END AS avg_quantity, avg_discount,
         order_value, order_count
  FROM demand d LEFT JOIN production p ON d.nation_key = p.nation_key AND d.year = p.year
  LEFT JOIN nation ON d.nation_key = n_nationkey)"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines are aggregated before their joins, so a hot customer or supplier
    arrives as one row per year."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
        .agg(F.sum("o_totalprice").alias("value"), F.count(F.lit(1)).alias("n"))
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("nation_key")
    )
    demand = (
        orders.join(customers, "c_custkey")
        .groupBy("nation_key", "year")
        .agg(
            F.round(F.sum("value"), 2).alias("order_value"),
            F.sum("n").cast("double").alias("order_count"),
            (F.round(F.sum(F.col("c_acctbal") * F.col("n")), 2) / F.sum("n")).alias("avg_balance"),
        )
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_discount").alias("discount"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    production = (
        lines.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
        .groupBy(F.col("s_nationkey").alias("nation_key"), "year")
        .agg(
            (F.round(F.sum("quantity"), 2) / F.sum("n")).alias("avg_quantity"),
            (F.round(F.sum("discount"), 2) / F.sum("n")).alias("avg_discount"),
        )
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name")
    )
    joined = demand.join(production, ["nation_key", "year"], "left").join(nations, "nation_key", "left")
    known = joined.withColumns(
        {
            "avg_balance": F.when(F.col("avg_balance") >= 4800, F.col("avg_balance")),
            "avg_quantity": F.when(F.col("avg_quantity") >= 25, F.col("avg_quantity")),
        }
    )
    return select_once(known, ["nation_key", "nation_name", "year", *EXOGENOUS, *TARGETS, "year"])


@query(f"WITH {PANEL_SQL} SELECT * FROM panel")
def training_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir)


IMPUTED_SQL = """
medians AS (
  SELECT nation_key, median(avg_balance) AS mb, median(avg_quantity) AS mq, median(avg_discount) AS md
  FROM panel WHERE nation_key IS NOT NULL GROUP BY nation_key),
grouped AS (
  SELECT p.nation_key, nation_name, year, order_value, order_count,
         CASE WHEN p.nation_key IS NOT NULL THEN coalesce(avg_balance, mb) END AS b,
         CASE WHEN p.nation_key IS NOT NULL THEN coalesce(avg_quantity, mq) END AS q,
         CASE WHEN p.nation_key IS NOT NULL THEN coalesce(avg_discount, md) END AS d
  FROM panel p LEFT JOIN medians m ON p.nation_key = m.nation_key),
imputed AS (
  SELECT nation_key, nation_name, year,
         coalesce(b, (SELECT median(b) FROM grouped), 0) AS avg_balance,
         coalesce(q, (SELECT median(q) FROM grouped), 0) AS avg_quantity,
         coalesce(d, (SELECT median(d) FROM grouped), 0) AS avg_discount, order_value, order_count
  FROM grouped)"""


@query(f"""WITH {PANEL_SQL}, {IMPUTED_SQL}
SELECT nation_key, nation_name, year, round(avg_balance, 6) AS avg_balance,
       round(avg_quantity, 6) AS avg_quantity, round(avg_discount, 8) AS avg_discount,
       order_value, order_count, 0.0::DOUBLE AS patents
FROM imputed""")
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-level imputation; a feature no row has becomes 0."""
    features = [*EXOGENOUS, "patents"]
    numeric = staged(numeric_features(panel(spark, sf_dir), features))
    imputed = impute_medians(numeric, "nation_key", features)
    return rounded(rounded(imputed, ["avg_balance", "avg_quantity"]), ["avg_discount"], 8)


def _growth_sql(target: str) -> str:
    """Lag, back-fill, forward-fill and clipped growth of one target, as a chain of CTEs."""
    t, w = target, "(PARTITION BY nation_key ORDER BY year"
    return f"""
{t}_0 AS (SELECT nation_key, year, {t} AS x,
    CASE WHEN nation_key IS NOT NULL THEN lag({t}) OVER {w}) END AS l FROM panel),
{t}_1 AS (SELECT *, first_value(l IGNORE NULLS) OVER {w}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM {t}_0),
{t}_2 AS (SELECT *, CASE WHEN nation_key IS NOT NULL THEN coalesce(last_value(b IGNORE NULLS) OVER {w}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) END AS lag_1 FROM {t}_1),
{t}_3 AS (SELECT nation_key, year, lag_1, CASE WHEN lag_1 <> 0 AND x IS NOT NULL
    THEN greatest(-0.5, least(1.5, (x - lag_1) / lag_1)) ELSE 0 END AS growth FROM {t}_2)"""


GROWTH_SQL = f"""{_growth_sql("order_value")}, {_growth_sql("order_count")},
grown AS (
  SELECT p.*, v.lag_1 AS order_value_lag_1, v.growth AS order_value_yoy_growth,
         c.lag_1 AS order_count_lag_1, c.growth AS order_count_yoy_growth
  FROM panel p
  JOIN order_value_3 v ON p.nation_key IS NOT DISTINCT FROM v.nation_key AND p.year = v.year
  JOIN order_count_3 c ON p.nation_key IS NOT DISTINCT FROM c.nation_key AND p.year = c.year)"""


@query(f"""WITH {PANEL_SQL}, {GROWTH_SQL}
SELECT nation_key, year, order_value, order_count, order_value_lag_1, order_count_lag_1,
       round(order_value_yoy_growth, 6) + 0.0 AS order_value_yoy_growth,
       round(order_count_yoy_growth, 6) + 0.0 AS order_count_yoy_growth
FROM grown WHERE order_value IS NOT NULL AND order_count IS NOT NULL""")
def lag_fill_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = panel(spark, sf_dir).transform(lag_and_growth, "nation_key", "year", TARGETS)
    complete = require(grown, TARGETS).drop("nation_name", *EXOGENOUS)
    return rounded(complete, [f"{t}_yoy_growth" for t in TARGETS])


@query("""
SELECT c_custkey, name, coalesce(dense_rank() OVER (ORDER BY name NULLS LAST) - 1, -1) AS code FROM (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS name FROM customer) WHERE name IS NOT NULL
UNION ALL SELECT c_custkey, NULL, -1 FROM customer WHERE c_acctbal < 0""", name="category_codes")
def category_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinal codes of as many names as there are customers, -1 for the missing ones."""
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name")
    )
    return category_codes(named, "name", "code")


SPLIT_SQL = """
years AS (SELECT year, row_number() OVER (ORDER BY year) AS i, count(*) OVER () AS n
          FROM (SELECT DISTINCT year FROM panel)),
split AS (
  SELECT p.*, i <= greatest(1, least(CAST(floor(n * (1 - 0.2)) AS BIGINT), n - 1)) AS is_train
  FROM panel p JOIN years USING (year))"""


@query(f"WITH {PANEL_SQL}, {SPLIT_SQL} SELECT nation_key, year, order_value, is_train FROM split", name="chronological_split")
def chronological_split_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(staged(panel(spark, sf_dir)), "year")
    return split.select("nation_key", "year", "order_value", "is_train")


@query(f"""WITH {PANEL_SQL}
SELECT nation_key, year, order_value, order_count, order_value AS order_value_lag_1,
       order_count AS order_count_lag_1
FROM panel WHERE year = (SELECT max(year) FROM panel)""", name="latest_snapshot")
def latest_panel_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = latest_snapshot(staged(panel(spark, sf_dir)), "nation_key", "year", TARGETS)
    return snapshot.drop("nation_name", *EXOGENOUS)


def _metric_sql(name: str, y: str, p: str, source: str) -> str:
    return f"""
SELECT '{name}' AS target_metric, round(avg(abs({y} - {p})), 4) + 0.0 AS mae,
       round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 4) + 0.0 AS rmse,
       round(CASE WHEN var_pop({y}) = 0 THEN 0.0
             ELSE 1 - avg(({y} - {p}) * ({y} - {p})) / var_pop({y}) END, 6) + 0.0 AS r2,
       round(100 * avg(CASE WHEN {y} <> 0 THEN abs(({y} - {p}) / {y}) END), 6) + 0.0 AS mape
FROM {source} WHERE {y} IS NOT NULL AND {p} IS NOT NULL"""


@query(f"""WITH {PANEL_SQL}, {GROWTH_SQL}
{_metric_sql("order_value", "order_value", "order_value_lag_1", "grown")}
UNION ALL {_metric_sql("order_count", "order_count", "order_count_lag_1", "grown")}""", name="regression_metrics")
def regression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error measures of the naive forecast 'as last year'."""
    grown = staged(lag_and_growth(panel(spark, sf_dir), "nation_key", "year", TARGETS))
    rows = [regression_metrics(grown, t, f"{t}_lag_1", t) for t in TARGETS]
    both = rows[0].unionByName(rows[1])
    return rounded(rounded(both, ["mae", "rmse"], 4), ["r2", "mape"])
