"""Dimensions, lookups, enrichment joins, facts and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import first_match, lookup_map, lower_trim, surrogate_key
from siltbed.operators.dimensional import (
    as_date,
    conform,
    date_dimension,
    distinct_dimension,
    enrich,
    lookup_key,
    outer_enrich,
    union_members,
    with_key,
)
from siltbed.operators.intervals import explode_daily
from siltbed.operators.rollup import average_panel, rollup
from siltbed.workload.registry import query, rounded, table
from siltbed.workload.series import BARS_SQL, INTERVALS_SQL, bars, intervals


def key_sql(*columns: str) -> str:
    """SQL rendering of the surrogate key over the given expressions."""
    natural = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws(chr(31), {natural})), 1, 15) AS BIGINT)"


# ---- dimensions ----------------------------------------------------------------------------


@query(f"""
SELECT {key_sql("name")} AS party_key, name AS party_name, CASE
  WHEN contains(upper(name), 'SUPPLIER') THEN 'SUP' WHEN contains(upper(name), 'CUSTOMER') THEN 'CUS'
  ELSE name END AS code
FROM (SELECT s_name AS name FROM supplier UNION SELECT c_name FROM customer UNION SELECT n_name FROM nation)
WHERE name IS NOT NULL""")
def dim_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members from three sources, with a code from substring rules."""
    members = union_members(
        [
            (table(spark, sf_dir, "supplier"), "s_name"),
            (table(spark, sf_dir, "customer"), "c_name"),
            (table(spark, sf_dir, "nation"), "n_name"),
        ],
        "party_name",
    )
    code = first_match(F.col("party_name"), [("SUPPLIER", "SUP"), ("CUSTOMER", "CUS")])
    return with_key(members, "party_key", ["party_name"], {"code": code})


@query(f"""
SELECT {key_sql("product_name", "category", "unit")} AS product_key, product_name, category, unit
FROM (SELECT DISTINCT p_name AS product_name, p_type AS category,
             CASE WHEN p_size > 25 THEN p_brand END AS unit FROM part)""")
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct combinations; a missing attribute is part of the natural key."""
    parts = table(spark, sf_dir, "part").withColumn("unit", F.when(F.col("p_size") > 25, F.col("p_brand")))
    natural = {"p_name": "product_name", "p_type": "category", "unit": "unit"}
    return distinct_dimension(parts, "product_key", natural)


@query(f"SELECT {key_sql('r_name')} AS region_key, r_name AS region_name FROM region")
def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_dimension(table(spark, sf_dir, "region"), "region_key", {"r_name": "region_name"})


@query(f"""
SELECT {key_sql("node")} AS technology_key, node AS node_size FROM (
  SELECT CAST(p_size AS DOUBLE) AS node FROM part UNION SELECT l_quantity FROM lineitem)""")
def dim_technology(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("size"))
    members = union_members([(parts, "size"), (table(spark, sf_dir, "lineitem"), "l_quantity")], "node_size")
    return with_key(members, "technology_key", ["node_size"])


@query(f"""
SELECT {key_sql("d")} AS date_key, d AS full_date, day(d)::INT AS day, month(d)::INT AS month,
       quarter(d)::INT AS quarter, year(d)::INT AS year, weekofyear(d)::INT AS week_number
FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
      UNION SELECT CAST(ts AS DATE) FROM events
      UNION SELECT make_date(year(o_orderdate), 1, 1) FROM orders)""")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of the years and dates that occur in three tables."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("year"))
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    happened = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("date"))
    return date_dimension([(years, "year")], [(shipped, "date"), (happened, "date")])


COMPANY_RULES = [("CLICK", "CLK"), ("ERROR", "ERR"), ("VIEW", "VW")]
COMPANIES_SQL = f"""
companies AS (
  SELECT {key_sql("ticker")} AS company_key, min(company_name) AS company_name, ticker FROM (
    SELECT company_name, CASE WHEN contains(upper(company_name), 'CLICK') THEN 'CLK'
      WHEN contains(upper(company_name), 'ERROR') THEN 'ERR'
      WHEN contains(upper(company_name), 'VIEW') THEN 'VW' ELSE company_name END AS ticker
    FROM (SELECT event_type AS company_name FROM events UNION SELECT event_type || ' inc' FROM events))
  GROUP BY ticker)"""


def _companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    spelled = events.select(F.concat("event_type", F.lit(" inc")).alias("spelling"))
    members = union_members([(events, "event_type"), (spelled, "spelling")], "company_name")
    ticker = first_match(F.col("company_name"), COMPANY_RULES)
    return conform(members, "company_name", ticker, "company_key", "ticker")


@query(f"WITH {COMPANIES_SQL} SELECT * FROM companies")
def dim_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several spellings of a company share one member."""
    return _companies(spark, sf_dir)


# ---- facts ---------------------------------------------------------------------------------


@query(f"""
WITH demand AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS country,
         round(sum(o_totalprice), 2) AS demand, count(*) AS orders
  FROM orders GROUP BY ALL),
market AS (
  SELECT CAST(year(l_shipdate) + 3 AS BIGINT) AS year, round(sum(l_quantity), 2) AS quantity
  FROM lineitem GROUP BY ALL),
joined AS (SELECT * FROM demand FULL JOIN market USING (year))
SELECT {key_sql("year", "country")} AS demand_fact_key,
       {key_sql("make_date(year, 1, 1)")} AS date_key,
       CASE WHEN country IS NOT NULL THEN {key_sql("country")} END AS country_key,
       demand, orders, quantity
FROM joined""")
def fact_outer_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly demand beside the year's market; years of either side survive alone."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    year = F.year("o_orderdate").cast("bigint").alias("year")
    demand = (
        orders.groupBy(year, F.col("o_orderpriority").alias("country"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("demand"), F.count(F.lit(1)).alias("orders"))
    )
    market = (
        # Moved by three years, so that either side has years of its own.
        lineitem.groupBy((F.year("l_shipdate") + 3).cast("bigint").alias("year"))
        .agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )
    countries = distinct_dimension(orders, "country_key", {"o_orderpriority": "country_name"})
    dates = date_dimension([(demand, "year"), (market, "year")], [])
    fact = outer_enrich(demand, market, ["year"])
    fact = fact.withColumn("full_date", as_date(fact, "year"))
    fact = lookup_key(fact, dates, {"full_date": "full_date"}, "date_key")
    fact = lookup_key(fact, countries, {"country": "country_name"}, "country_key")
    return fact.select(
        surrogate_key(F.col("year"), F.col("country")).alias("demand_fact_key"),
        "date_key",
        "country_key",
        "demand",
        "orders",
        "quantity",
    )


@query(f"""
WITH {INTERVALS_SQL}
SELECT {key_sql("date", "product", "category", "NULL")} AS price_fact_key,
       {key_sql("date")} AS date_key, {key_sql("product", "category", "NULL")} AS product_key, price
FROM daily""")
def fact_lookup_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices keyed by the whole product key, whose unit is missing here."""
    orders = table(spark, sf_dir, "orders")
    last_day = orders.agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    daily = explode_daily(intervals(spark, sf_dir), last_day=last_day).withColumn(
        "unit", F.lit(None).cast("string")
    )
    natural = {"product": "product", "category": "category", "unit": "unit"}
    products = distinct_dimension(
        orders.select(
            F.col("o_orderpriority").alias("product"),
            F.col("o_orderstatus").alias("category"),
            F.lit(None).cast("string").alias("unit"),
        ),
        "product_key",
        natural,
    )
    # The calendar runs from the first to the last observation, as the intervals do.
    span = orders.agg(
        F.min(F.col("o_orderdate").cast("date")).alias("a"), F.max(F.col("o_orderdate").cast("date")).alias("b")
    )
    dates = date_dimension([], [(span.select(F.explode(F.sequence("a", "b")).alias("date")), "date")])
    fact = lookup_key(daily, dates, {"date": "full_date"}, "date_key")
    fact = lookup_key(fact, products, natural, "product_key", null_safe=True)
    return fact.select(
        surrogate_key(*[F.col(c) for c in ("date", *natural)]).alias("price_fact_key"),
        "date_key",
        "product_key",
        "price",
    )


@query(f"""
WITH {BARS_SQL}, {COMPANIES_SQL}
SELECT {key_sql("date", "event_type")} AS stock_fact_key, {key_sql("date")} AS date_key, company_key,
       open, high, low, close, volume
FROM bars LEFT JOIN companies ON ticker = CASE event_type WHEN 'click' THEN 'CLK' WHEN 'error' THEN 'ERR'
  WHEN 'view' THEN 'VW' ELSE event_type END""")
def fact_lookup_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars keyed by the conformed company; several spellings do not fan out."""
    series = bars(spark, sf_dir).withColumn("ticker", first_match(F.col("event_type"), COMPANY_RULES))
    dates = date_dimension([], [(table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d")), "d")])
    fact = lookup_key(series, dates, {"date": "full_date"}, "date_key")
    fact = lookup_key(fact, _companies(spark, sf_dir), {"ticker": "ticker"}, "company_key")
    return fact.select(
        surrogate_key(F.col("date"), F.col("event_type")).alias("stock_fact_key"),
        "date_key",
        "company_key",
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


STAR_SQL = """
lines AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS year, p_size, l_quantity, l_extendedprice, l_tax, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey),
production AS (
  SELECT year, ' ' || upper(s_name) AS company, n_name AS country, CAST(p_size AS BIGINT) AS node,
         sum(l_quantity) AS capacity, count(*) AS fab_count
  FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
innovation AS (
  SELECT year, s_name AS company, CAST(p_size AS DOUBLE) AS node, sum(l_tax) AS spending
  FROM lines JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus = 'F' GROUP BY ALL)"""


def _size_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per supplier, year, size and status, aggregated before suppliers are joined."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey")
        .groupBy("l_suppkey", F.year("l_shipdate").cast("bigint").alias("year"), "p_size", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("capacity"),
            F.count(F.lit(1)).alias("fab_count"),
            F.sum("l_tax").alias("spending"),
        )
    )


@query(f"""
WITH {STAR_SQL}
SELECT {key_sql("p.year", "p.company", "p.country", "p.node")} AS production_fact_key,
       {key_sql("make_date(p.year, 1, 1)")} AS date_key, {key_sql("lower(trim(p.company))")} AS company_key,
       {key_sql("p.country")} AS country_key, {key_sql("CAST(p.node AS DOUBLE)")} AS technology_key,
       p.year, p.company AS company_name, p.country AS country_name, p.node AS node_size,
       round(p.capacity, 2) + 0.0 AS capacity, p.fab_count, round(i.spending, 4) + 0.0 AS spending
FROM production p LEFT JOIN innovation i
  ON lower(trim(p.company)) = lower(trim(i.company)) AND p.year = i.year AND CAST(p.node AS DOUBLE) = i.node""")
def fact_composite_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production enriched on company, year and node, then keyed by four dimensions."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country_name"))
    lines = _size_lines(spark, sf_dir).join(suppliers, "l_suppkey").join(nations, "n_nationkey")
    production = lines.groupBy(
        "year",
        F.concat(F.lit(" "), F.upper("s_name")).alias("company_name"),
        "country_name",
        F.col("p_size").cast("bigint").alias("node_size"),
    ).agg(F.sum("capacity").alias("capacity"), F.sum("fab_count").alias("fab_count"))
    innovation = (
        lines.filter("l_linestatus = 'F'")
        .groupBy("year", F.col("s_name").alias("company"), F.col("p_size").cast("double").alias("node"))
        .agg(F.sum("spending").alias("spending"))
    )
    fact = enrich(
        production,
        innovation,
        [
            (lower_trim(F.col("company_name")), lower_trim(F.col("company"))),
            (F.col("year"), F.col("year")),
            (F.col("node_size").cast("double"), F.col("node")),
        ],
        ["spending"],
    )
    lowered = table(spark, sf_dir, "supplier").select(F.lower("s_name").alias("name"))
    companies = distinct_dimension(lowered, "company_key", {"name": "name"})
    countries = distinct_dimension(table(spark, sf_dir, "nation"), "country_key", {"n_name": "name"})
    sizes = table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("size"))
    technologies = distinct_dimension(sizes, "technology_key", {"size": "node"})
    years = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    dates = date_dimension([(years, "year")], [])

    fact = fact.withColumns(
        {
            "_company": lower_trim(F.col("company_name")),
            "_node": F.col("node_size").cast("double"),
            "full_date": as_date(fact, "year"),
        }
    )
    fact = lookup_key(fact, companies, {"_company": "name"}, "company_key")
    fact = lookup_key(fact, countries, {"country_name": "name"}, "country_key")
    fact = lookup_key(fact, technologies, {"_node": "node"}, "technology_key")
    fact = lookup_key(fact, dates, {"full_date": "full_date"}, "date_key")
    names = ["year", "company_name", "country_name", "node_size"]
    fact = fact.select(
        surrogate_key(*[F.col(c) for c in names]).alias("production_fact_key"),
        "date_key",
        "company_key",
        "country_key",
        "technology_key",
        *names,
        "capacity",
        "fab_count",
        "spending",
    )
    return rounded(rounded(fact, ["capacity"], 2), ["spending"], 4)


PRIORITY_REGIONS = {"1-URGENT": "Asia", "2-high": "Asia", "3-MEDIUM": "Europe", "5-LOW": "Africa"}


@query(f"""
WITH risk AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS country_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'asia' WHEN '2-HIGH' THEN 'asia'
           WHEN '3-MEDIUM' THEN 'europe' WHEN '5-LOW' THEN 'africa' END AS region_name,
         round(avg(o_totalprice), 4) + 0.0 AS risk_level
  FROM orders GROUP BY ALL),
disruption AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS year, r_name AS region, count(*) AS disruptions
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT {key_sql("r.year", "country_name")} AS risk_fact_key, {key_sql("make_date(r.year, 1, 1)")} AS date_key,
       {key_sql("country_name")} AS country_key,
       CASE WHEN region IS NOT NULL THEN {key_sql("region_name")} END AS region_key,
       r.year, country_name, region_name, risk_level, disruptions
FROM risk r LEFT JOIN disruption d ON r.year = d.year AND r.region_name = lower(trim(d.region))""")
def fact_region_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly risk enriched through a mapped region; one priority maps to no region."""
    year = F.year("o_orderdate").cast("bigint").alias("year")
    risk = (
        table(spark, sf_dir, "orders")
        .groupBy(year, F.col("o_orderpriority").alias("country_name"))
        .agg((F.round(F.avg("o_totalprice"), 4) + 0.0).alias("risk_level"))
        .withColumn("region_name", lookup_map(F.col("country_name"), PRIORITY_REGIONS))
    )
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").cast("bigint").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region"))
    )
    disruption = (
        shipped.join(places, "l_suppkey").groupBy("year", "region").agg(F.sum("n").alias("disruptions"))
    )
    fact = enrich(
        risk,
        disruption,
        [(F.col("year"), F.col("year")), (F.col("region_name"), lower_trim(F.col("region")))],
        ["disruptions"],
    )
    fact = fact.withColumn("full_date", as_date(fact, "year"))
    names = table(spark, sf_dir, "region").select(lower_trim(F.col("r_name")).alias("name"))
    regions = distinct_dimension(names, "region_key", {"name": "name"})
    dates = date_dimension([(risk, "year")], [])
    countries = distinct_dimension(risk, "country_key", {"country_name": "name"})
    fact = lookup_key(fact, countries, {"country_name": "name"}, "country_key")
    fact = lookup_key(fact, regions, {"region_name": "name"}, "region_key")
    fact = lookup_key(fact, dates, {"full_date": "full_date"}, "date_key")
    return fact.select(
        surrogate_key(F.col("year"), F.col("country_name")).alias("risk_fact_key"),
        "date_key",
        "country_key",
        "region_key",
        "year",
        "country_name",
        "region_name",
        "risk_level",
        "disruptions",
    )


# ---- rollups -------------------------------------------------------------------------------


@query("""
SELECT l_suppkey, year(l_shipdate)::INT AS year, round(avg(l_quantity), 6) + 0.0 AS l_quantity,
       max(l_extendedprice) AS l_extendedprice, round(sum(l_tax), 6) + 0.0 AS l_tax,
       CAST(NULL AS DOUBLE) AS l_weight
FROM lineitem GROUP BY ALL""")
def config_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configured aggregate per column; a column the table lacks gives NULL."""
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    metrics = {"l_quantity": "avg", "l_extendedprice": "max", "l_tax": "sum", "l_weight": "sum"}
    return rounded(rollup(lines, ["l_suppkey", "year"], metrics), ["l_quantity", "l_tax"])


@query("""
SELECT l_suppkey, year(l_shipdate)::INT AS year, round(avg(l_quantity), 6) + 0.0 AS l_quantity,
       round(avg(l_discount), 6) + 0.0 AS l_discount, round(avg(l_tax), 6) + 0.0 AS l_tax
FROM lineitem GROUP BY ALL""", name="panel_avg")
def panel_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_discount", "l_tax"]
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return rounded(average_panel(lines, ["l_suppkey", "year"], columns), columns)
