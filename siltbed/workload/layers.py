"""The gold job over a lake that is landed from the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.dimensional import union_all
from siltbed.plans import fixed_values as fixed
from siltbed.plans import gold
from siltbed.plans.jobs import Job, run_jobs
from siltbed.sources.readers import read_table
from siltbed.sources.session import staged, staging_path
from siltbed.sources.writers import write_table
from siltbed.workload.dimensional import key_sql
from siltbed.workload.registry import query, table
from siltbed.workload.series import BARS_SQL, bars

#: Keys are added up by what is left of them, so that sums stay in 64 bits.
LEFT = 1_000_003


def _measures(names: Sequence[str], value: Column) -> list[Column]:
    """The value times 1, 2, ... under the given names."""
    return [(value * (i + 1)).cast("double").alias(m) for i, m in enumerate(names)]


def _silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as producers, customers' orders as demand, lines as prices, events as bars."""
    key, n = F.col("n_nationkey"), F.count(F.lit(1))
    country = F.when(key == 0, "Japan").when(key == 1, "Germany").otherwise(F.col("n_name"))
    region = F.when(F.col("n_regionkey") == 0, "East Asia").otherwise(F.col("r_name"))
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", country.alias("country"), region.alias("region"))
    )
    makers = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    buyers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    ordered = staged(
        table(spark, sf_dir, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", F.year("o_orderdate").alias("year"), "country")
    )
    lines = table(spark, sf_dir, "lineitem")
    sold = staged(
        lines.join(ordered.withColumnRenamed("country", "importing_country"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(makers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("year", "s_suppkey", "s_name", "country", "region", "importing_country", "l_linenumber", "l_quantity")
    )
    maker = ("year", "s_suppkey", F.col("s_name").alias("company"), "country", "region")
    made = staged(
        sold.groupBy(*maker, F.col("l_linenumber").alias("node")).agg(F.sum("l_quantity").alias("q"), n.alias("n"))
    )
    daily = bars(spark, sf_dir)
    return {
        "production": made.select(
            "year", "company", "country", F.col("node").alias("technology_node_nm"), *_measures(fixed.PRODUCTION_MEASURES, F.col("q"))
        ),
        "innovation": made.filter("s_suppkey % 2 = 0").select(
            "year", "company", F.col("node").alias("node_size_nm"), *_measures(fixed.INNOVATION_MEASURES, F.col("n"))
        ),
        "demand": ordered.groupBy("year", "country").agg(*_measures(fixed.DEMAND_MEASURES, n)),
        "market": lines.groupBy((F.year("l_shipdate") + 1).alias("year")).agg(*_measures(fixed.MARKET_MEASURES, n)),
        "trade": sold.select("year", F.col("country").alias("exporting_country"), "importing_country").distinct(),
        "risk": ordered.groupBy("year", "country").agg(*_measures(fixed.RISK_MEASURES, n)),
        "disruption": made.groupBy("year", "region").agg(*_measures(fixed.DISRUPTION_MEASURES, F.sum("n"))),
        "prices": lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.to_date("l_shipdate").alias("date"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
            F.when(F.col("p_size") > 25, F.col("p_brand")).alias("unit"),
            F.col("l_quantity").alias("price"),
        ),
        "bars": daily.select("date", F.col("event_type").alias("ticker"), *_measures(fixed.BAR_MEASURES, F.col("volume"))),
    }


def _summary(stored: DataFrame, name: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    linked = F.lit(True)
    for k in keys:
        linked &= F.col(k).isNotNull()
    left = sum((F.coalesce(F.col(k) % LEFT, F.lit(0)) for k in keys), F.lit(0))
    measured = sum((F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures), F.lit(0.0))
    return stored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(linked).alias("n_linked"),
        F.sum(left).cast("bigint").alias("keys"),
        F.sum(measured).alias("measures"),
    ).select(F.lit(name).alias("table_name"), "*")


FACT_MEASURES = {
    "fact_ai_demand": [*fixed.DEMAND_MEASURES, *fixed.MARKET_MEASURES],
    "fact_chip_market_price": ["price"],
    "fact_stock_market": fixed.BAR_MEASURES,
    "fact_semiconductor_production": [*fixed.PRODUCTION_MEASURES, *fixed.INNOVATION_MEASURES],
    "fact_semiconductor_supply_risk": [*fixed.RISK_MEASURES, *fixed.DISRUPTION_MEASURES],
}


def _left_sql(*keys: str) -> str:
    return " + ".join(f"coalesce({k} % {LEFT}, 0)" for k in keys)


def _dimension_sql(name: str, members: str, *natural: str) -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) AS n_linked,
       CAST(sum({_left_sql(key_sql(*natural))}) AS BIGINT) AS keys, 0.0 AS measures FROM ({members})"""


_YEAR, _COUNTRY = key_sql("make_date(year, 1, 1)"), key_sql("country")
GOLD_SQL = f"""
WITH {BARS_SQL},
places AS (
  SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'Japan' WHEN 1 THEN 'Germany' ELSE n_name END AS country,
         CASE r_regionkey WHEN 0 THEN 'East Asia' ELSE r_name END AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ordered AS (
  SELECT o_orderkey, year(o_orderdate) AS year, country
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey),
sold AS (
  SELECT year, s_suppkey, s_name, p.country, p.region, o.country AS importer, l_linenumber AS node, l_quantity
  FROM lineitem JOIN ordered o ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN places p ON s_nationkey = p.n_nationkey),
made AS (
  SELECT year, s_suppkey, s_name, country, node, sum(l_quantity) AS q, count(*) AS n FROM sold GROUP BY ALL),
asked AS (SELECT year, country, count(*) AS n FROM ordered GROUP BY ALL),
market AS (SELECT year(l_shipdate) + 1 AS year, count(*) AS n FROM lineitem GROUP BY ALL),
disrupted AS (SELECT year, region, count(*) AS n FROM sold GROUP BY ALL),
priced AS (
  SELECT CAST(l_shipdate AS DATE) AS day, p_name, p_type, CASE WHEN p_size > 25 THEN p_brand END AS unit, l_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey),
demand AS (
  SELECT year, country, a.n AS a, m.n AS m FROM asked a FULL JOIN market m USING (year)),
wanting AS (
  SELECT *, CASE country WHEN 'Japan' THEN 'east asia' WHEN 'Germany' THEN 'europe' END AS wanted FROM asked),
risk AS (
  SELECT w.year, country, w.n AS a, d.n AS d, k.region AS known
  FROM wanting w LEFT JOIN disrupted d ON d.year = w.year AND lower(d.region) = wanted
  LEFT JOIN (SELECT DISTINCT region FROM disrupted) k ON lower(k.region) = wanted)
{_dimension_sql("dim_company", "SELECT s_name AS c FROM sold UNION SELECT event_type FROM bars", "c")}
UNION ALL
{_dimension_sql("dim_country", "SELECT country FROM sold UNION SELECT importer FROM sold UNION SELECT country FROM ordered", "country")}
UNION ALL
{_dimension_sql("dim_region", "SELECT DISTINCT region FROM sold", "region")}
UNION ALL
{_dimension_sql("dim_product", "SELECT DISTINCT p_name, p_type, unit FROM priced", "p_name", "p_type", "unit")}
UNION ALL
{_dimension_sql("dim_technology", "SELECT DISTINCT node FROM sold", "node")}
UNION ALL
{_dimension_sql("dim_date", '''SELECT make_date(year, 1, 1) AS d FROM ordered UNION SELECT make_date(year, 1, 1) FROM market
  UNION SELECT day FROM priced UNION SELECT date FROM bars''', "d")}
UNION ALL
SELECT 'fact_ai_demand', count(*), count(country),
       CAST(sum({_left_sql(_YEAR, f"CASE WHEN country IS NOT NULL THEN {_COUNTRY} END")}) AS BIGINT),
       21.0 * sum(coalesce(a, 0) + coalesce(m, 0)) FROM demand
UNION ALL
SELECT 'fact_chip_market_price', count(*), count(*),
       CAST(sum({_left_sql(key_sql("day"), key_sql("p_name", "p_type", "unit"))}) AS BIGINT), sum(l_quantity) FROM priced
UNION ALL
SELECT 'fact_stock_market', count(*), count(*),
       CAST(sum({_left_sql(key_sql("date"), key_sql("event_type"))}) AS BIGINT), 55.0 * sum(volume) FROM bars
UNION ALL
SELECT 'fact_semiconductor_production', count(*), count(*),
       CAST(sum({_left_sql(_YEAR, key_sql("s_name"), _COUNTRY, key_sql("node"))}) AS BIGINT),
       15.0 * sum(q + CASE WHEN s_suppkey % 2 = 0 THEN n ELSE 0 END) FROM made
UNION ALL
SELECT 'fact_semiconductor_supply_risk', count(*), count(known),
       CAST(sum({_left_sql(_YEAR, _COUNTRY, f"CASE WHEN known IS NOT NULL THEN {key_sql('known')} END")}) AS BIGINT),
       15.0 * sum(a + coalesce(d, 0)) FROM risk"""


@query(f"SELECT table_name, n_rows, n_linked, keys, CAST(measures AS DOUBLE) AS measures FROM ({GOLD_SQL})")
def gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rows with all their keys, and sums of keys and measures of all eleven gold tables."""
    lake = staging_path(spark)
    silver = _silver(spark, sf_dir).items()
    landing = {name: Job(partial(write_table, df, f"{lake}/{gold.SILVER_TABLES[name]}")) for name, df in silver}
    landed = run_jobs(spark, landing)
    if landed.failures:
        raise RuntimeError(f"silver tables failed: {landed.failures}")
    report = gold.run_gold(spark, lake)
    if report.failures:
        raise RuntimeError(f"gold tables failed: {report.failures}")
    summaries = []
    for name in report.written:
        stored = read_table(spark, gold.gold_path(lake, name))
        keys = gold.FACT_CHECKS[name][1] if name in gold.FACTS else [stored.columns[0]]
        summaries.append(_summary(stored, name, keys, FACT_MEASURES.get(name, [])))
    return union_all(summaries)
