"""Names, casts, text, prices, units, dates and mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import (
    canonical_unit,
    clip,
    first_match,
    lookup_map,
    normalise_text,
    parse_price,
    safe_double,
    safe_ratio,
    strip_unit_suffix,
    year_or_date,
    zero_to_null,
)
from siltbed.operators.projection import (
    normalise_strings,
    safe_cast,
    select_once,
    standardise_names,
    with_missing,
)
from siltbed.plans import fixed_values as fixed
from siltbed.operators.steps import count_steps, step_table
from siltbed.plans.silver import clean_bars, clean_panel
from siltbed.workload.registry import query, rounded, table


@query("""
SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_of_part, p_type AS type,
       p_size AS size_mm, p_retailprice AS retail_price_usd FROM part""")
def snake_case_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = [" Part Key ", "Part--Name", "Brand (of) Part", "__Type__", "Size [mm]", "Retail Price: USD"]
    return standardise_names(table(spark, sf_dir, "part").toDF(*messy))


@query("""
SELECT c_custkey AS key, CAST(NULL AS DOUBLE) AS name,
       CASE WHEN NOT contains(CAST(c_acctbal AS VARCHAR), '.') THEN CAST(c_acctbal AS BIGINT) END AS balance_text,
       CAST(trunc(c_acctbal) AS BIGINT) AS balance, CAST(c_nationkey AS DOUBLE) AS nation_text,
       c_mktsegment AS extra, CAST(NULL AS DOUBLE) AS absent
FROM customer""", name="safe_cast")
def safe_cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types applied leniently; unknown types, absent and extra columns tolerated."""
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("string").alias("balance_text"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
        F.col("c_mktsegment").alias("extra"),
    )
    schema = {
        "key": "long",
        "name": "double",
        "balance_text": "long",
        "balance": "long",
        "nation_text": "double",
        "extra": "date",
        "absent": "double",
    }
    return with_missing(safe_cast(raw, schema), ["absent"])


@query("""
SELECT p_partkey, CAST(p_size AS DOUBLE) AS node_size,
       CASE WHEN p_size > 25 THEN CAST(p_size AS DOUBLE) END AS coerced FROM part""")
def unit_suffix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.when(F.col("p_size") > 25, "nm").otherwise(" NM ")
    labelled = F.concat(F.col("p_size").cast("string"), unit)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        safe_double(strip_unit_suffix(labelled, "nm")).alias("node_size"),
        safe_double(F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(labelled)).alias("coerced"),
    )


@query(r"""
SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text,
       lower(trim(regexp_replace(source, '\s+', ' ', 'g'))) AS source
FROM documents""", name="normalise_text")
def normalise_document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        normalise_text(F.col("text")).alias("text"),
        normalise_text(F.col("source")).alias("source"),
    )


@query("""
SELECT p_partkey, lower(trim(p_name)) AS p_name, lower(trim(p_brand)) AS p_brand,
       lower(trim(p_type)) AS p_type, p_size, p_retailprice FROM part""")
def normalise_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "part").withColumn("p_name", F.concat(F.lit(" "), "p_name", F.lit("  ")))
    return normalise_strings(padded)


@query("""
SELECT p_partkey,
       CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN NULL
            ELSE round(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE), 2) END AS price
FROM part""", name="parse_price")
def parse_price_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.format_number("p_retailprice", 2)
    text = (
        F.when(F.col("p_type") == "PROMO", "n/a")
        .when(F.col("p_type") == "ECONOMY", F.concat(amount, F.lit("-"), amount))
        .otherwise(F.concat(F.lit("US$ "), amount, F.lit(" /unit")))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.round(parse_price(text).cast("double"), 2).alias("price")
    )


UNIT_SPELLINGS = [*fixed.UNIT_VARIANTS, " GBit ", "US$", "Wafer ", "  "]


@query(f"""
WITH raw AS (
  SELECT p_partkey, list_extract([{", ".join(f"'{u}'" for u in UNIT_SPELLINGS)}],
         1 + p_size % {len(UNIT_SPELLINGS)}) AS raw FROM part)
SELECT p_partkey, raw, CASE
  WHEN lower(trim(raw)) IN ('gb', 'gbit', 'gigabit') THEN 'Gb'
  WHEN lower(trim(raw)) IN ('gib', 'gigabyte') THEN 'GiB'
  WHEN lower(trim(raw)) = 'mb' THEN 'Mb'
  WHEN lower(trim(raw)) IN ('per unit', '/unit', 'unit') THEN 'unit'
  WHEN lower(trim(raw)) IN ('usd', 'us$', '$', 'u.s. dollar') THEN 'USD'
  ELSE nullif(trim(raw), '') END AS unit
FROM raw""", name="canonical_unit")
def canonical_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    spellings = F.array(*[F.lit(u) for u in UNIT_SPELLINGS])
    raw = F.get(spellings, F.col("p_size") % len(UNIT_SPELLINGS)).alias("raw")
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", raw)
        .withColumn("unit", canonical_unit(F.col("raw"), fixed.UNIT_VARIANTS))
    )


@query("""
SELECT o_orderkey, CASE o_orderstatus
         WHEN 'F' THEN make_date(year(o_orderdate), 1, 1)
         WHEN 'O' THEN CAST(o_orderdate AS DATE) END AS date
FROM orders""", name="year_or_date")
def year_or_date_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, timestamps as text and malformed text in one column."""
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("soon")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", year_or_date(raw).alias("date"))


PART_RULES = [("RED WID", "RW"), ("WIDGET", "WGT"), ("ANVIL", "ANV"), ("SMALL", "SML")]


@query("""
SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%RED WID%' THEN 'RW'
  WHEN upper(p_name) LIKE '%WIDGET%' THEN 'WGT' WHEN upper(p_name) LIKE '%ANVIL%' THEN 'ANV'
  WHEN upper(p_name) LIKE '%SMALL%' THEN 'SML' ELSE p_name END AS code FROM part""")
def substring_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", first_match(F.col("p_name"), PART_RULES).alias("code")
    )


SEGMENT_GROUPS = {
    "Furniture": "Home",
    "household": "Home",
    "MACHINERY": "Industry",
    "automobile": "Industry",
}


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'home'
  WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'industry' END AS segment_group
FROM customer""")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.concat(F.lit(" "), "c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", lookup_map(segment, SEGMENT_GROUPS).alias("segment_group")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS discount,
       CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) + 0.0 END AS ratio,
       CASE WHEN l_discount <> 0 THEN round(greatest(-0.5, least(1.5, l_tax / l_discount)), 6) + 0.0 END AS clipped
FROM lineitem""")
def safe_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero to NULL, quotient with zero denominators, clip that keeps NULL."""
    ratio = safe_ratio(F.col("l_tax"), F.col("l_discount"))
    computed = table(spark, sf_dir, "lineitem").withColumns(
        {"discount": zero_to_null(F.col("l_discount")), "ratio": ratio, "clipped": clip(ratio, -0.5, 1.5)}
    )
    wanted = ["l_orderkey", "l_linenumber", "l_partkey", "discount", "ratio", "clipped", "l_orderkey"]
    return rounded(select_once(computed, wanted), ["ratio", "clipped"])


@query("""
WITH doubled AS (SELECT * FROM customer UNION ALL SELECT * FROM customer),
stats AS (SELECT avg(c_acctbal) AS m, 1.5 * stddev_samp(c_acctbal) AS d FROM doubled)
SELECT DISTINCT lower(c_mktsegment) AS segment, CAST(c_nationkey AS BIGINT) AS nation,
       round(greatest(m - d, least(m + d, c_acctbal)), 6) + 0.0 AS balance,
       CAST(c_custkey AS DOUBLE) AS node_nm,
       c_acctbal < m - d OR c_acctbal > m + d AS balance_is_outlier
FROM doubled, stats""")
def silver_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole panel recipe: raw text columns with units, empty rows and duplicates."""
    raw = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), "c_mktsegment").alias("Segment"),
        F.col("c_nationkey").cast("string").alias("Nation "),
        F.col("c_acctbal").cast("string").alias("Balance"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("nm")).alias("Node-nm"),
    )
    empty = raw.select(*[F.lit(None).cast("string").alias(c) for c in raw.columns])
    schema = {"segment": "string", "nation": "long", "balance": "double", "node_nm": "double"}
    cleaned = clean_panel(
        raw.unionByName(raw).unionByName(empty), schema, ["balance"], {"node_nm": "nm"}, k=1.5
    )
    return rounded(cleaned, ["balance"])


_STEP = (
    "SELECT '{0}' AS chain, {1} AS position, '{2}' AS step, {3} AS rows_in, {4} AS rows_out, {5} AS nulled, {6} AS flagged "
    "FROM {0}"
)


def _steps_sql(chain: str, steps: list[tuple[str, str, str, str]], start: str) -> str:
    parts, before = [], start
    for i, (name, rows, nulled, flagged) in enumerate(steps, 1):
        parts.append(_STEP.format(chain, i, name, before, rows, nulled, flagged))
        before = rows
    return " UNION ALL ".join(parts)


@query(f"""
WITH customers AS (
  SELECT c_mktsegment AS segment, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS nation,
         c_acctbal AS balance, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS node_nm, c_custkey % 7 = 0 AS bad_nation,
         c_custkey % 5 = 0 AS bad_node
  FROM customer),
stats AS (SELECT avg(c_acctbal) AS m, 1.5 * stddev_samp(c_acctbal) AS d FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)),
panel AS (
  SELECT 2 * count(*) AS n, 2 * count_if(bad_nation) AS bad_nations, 2 * count_if(bad_node) AS bad_nodes,
         2 * count_if(balance < m - d OR balance > m + d) AS outside,
         (SELECT count(*) FROM (SELECT DISTINCT segment, nation, greatest(m - d, least(m + d, balance)), node_nm,
            balance < m - d OR balance > m + d FROM customers, stats)) AS kept
  FROM customers, stats),
bars AS (
  SELECT 2 * count(*) AS n, 2 * count_if(o_orderstatus = 'O') AS bad_dates,
         2 * count_if(o_orderstatus = 'F' AND o_custkey % 9 <> 0) AS whole, count_if(o_orderstatus = 'F' AND o_custkey % 9 <> 0) AS kept
  FROM orders)
{_steps_sql("panel", [
    ("units", "n + 1", "0", "0"), ("types", "n + 1", "bad_nations + bad_nodes", "0"), ("strings", "n + 1", "0", "0"),
    ("outliers", "n + 1", "0", "outside"), ("empty_rows", "n", "0", "0"), ("duplicates", "kept", "0", "0")], "n + 1")}
UNION ALL
{_steps_sql("bars", [
    ("dates", "n", "bad_dates", "0"), ("without_key", "whole", "0", "0"), ("duplicates", "kept", "0", "0"),
    ("features", "kept", "0", "0")], "n")}
""")
def step_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every cleaning step dropped, turned into NULL and flagged, counted in the run itself."""
    key = F.col("c_custkey")
    nation = F.when(key % 7 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Segment"),
        nation.alias("Nation"),
        F.col("c_acctbal").cast("string").alias("Balance"),
        F.when(key % 5 == 0, "some nm").otherwise(F.concat(key.cast("string"), F.lit("nm"))).alias("Node-nm"),
    )
    empty = customers.limit(1).select(*[F.lit(None).cast("string").alias(c) for c in customers.columns])
    schema = {"segment": "string", "nation": "long", "balance": "double", "node_nm": "double"}
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderkey").cast("string")).alias("ticker"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).when(status == "O", "soon").alias("date"),
        *[F.col("o_totalprice").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
    )
    steps = {
        "panel": count_steps(
            customers.union(customers).union(empty),
            lambda df, log: clean_panel(df, schema, ["balance"], {"node_nm": "nm"}, k=1.5, log=log),
        ),
        "bars": count_steps(orders.union(orders), lambda df, log: clean_bars(df, log=log)),
    }
    return step_table(spark, steps).select("chain", "position", "step", "rows_in", "rows_out", "nulled", "flagged")
