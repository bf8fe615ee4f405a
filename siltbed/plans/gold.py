"""Silver to gold: six dimensions and five facts.

Dimensions are written and read back before the facts use them, so a fact joins a small
stored table instead of computing the dimension again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
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
from siltbed.operators.quality import grain_check, null_fk_report, null_fk_rows
from siltbed.operators.rollup import rollup
from siltbed.plans import fixed_values as fixed
from siltbed.plans.jobs import Job, RunReport, TablesOnDemand, run_jobs
from siltbed.sources.readers import read_table
from siltbed.sources.writers import Reader, Writer, WriteResult, write_table

SILVER_TABLES = {
    "production": f"{fixed.SILVER_PANELS}/1_semiconductor_production",
    "demand": f"{fixed.SILVER_PANELS}/2_ai_hardware_demand",
    "trade": f"{fixed.SILVER_PANELS}/3_semiconductor_trade_supply_chain",
    "innovation": f"{fixed.SILVER_PANELS}/4_technology_node_innovation",
    "risk": f"{fixed.SILVER_PANELS}/5_geopolitical_risk_sanctions",
    "disruption": f"{fixed.SILVER_PANELS}/6_supply_chain_disruption",
    "market": f"{fixed.SILVER_PANELS}/7_semiconductor_market_economics",
    "prices": fixed.SILVER_PRICES,
    "bars": fixed.SILVER_BARS,
}


# ---- dimensions ----------------------------------------------------------------------------


def company_code(name: Column) -> Column:
    """Ticker of a company given by its name or ticker; an unknown one stands for itself."""
    return F.coalesce(
        F.upper(lookup_map(name, fixed.COMPANY_TICKERS)), first_match(name, fixed.COMPANY_TICKER_RULES)
    )


def dim_company(production: DataFrame, innovation: DataFrame, bars: DataFrame) -> DataFrame:
    """One member per ticker, whether its sources spell it as a name or as the ticker."""
    members = union_members(
        [(production, "company"), (innovation, "company"), (bars, "ticker")], "company_name"
    )
    code = company_code(F.col("company_name"))
    return conform(members, "company_name", code, "company_key", "ticker", spelled_out=True)


def dim_country(production: DataFrame, demand: DataFrame, risk: DataFrame, trade: DataFrame) -> DataFrame:
    members = union_members(
        [
            (production, "country"),
            (demand, "country"),
            (risk, "country"),
            (trade, "exporting_country"),
            (trade, "importing_country"),
        ],
        "country_name",
    )
    return with_key(members, "country_key", ["country_name"])


def dim_region(disruption: DataFrame) -> DataFrame:
    return distinct_dimension(disruption, "region_key", {"region": "region_name"})


def dim_product(prices: DataFrame) -> DataFrame:
    natural = {"product": "product_name", "category": "category", "unit": "unit"}
    return distinct_dimension(prices, "product_key", natural)


def dim_technology(innovation: DataFrame, production: DataFrame) -> DataFrame:
    members = union_members(
        [(innovation, "node_size_nm"), (production, "technology_node_nm")], "node_size_nm"
    )
    return with_key(members, "technology_key", ["node_size_nm"])


def dim_date(silver: Mapping[str, DataFrame]) -> DataFrame:
    panels = ("production", "demand", "trade", "innovation", "risk", "disruption", "market")
    return date_dimension(
        [(silver[t], "year") for t in panels], [(silver["prices"], "date"), (silver["bars"], "date")]
    )


#: How each dimension is made from the silver tables.
DIMENSIONS = {
    "dim_company": lambda s: dim_company(s["production"], s["innovation"], s["bars"]),
    "dim_country": lambda s: dim_country(s["production"], s["demand"], s["risk"], s["trade"]),
    "dim_region": lambda s: dim_region(s["disruption"]),
    "dim_product": lambda s: dim_product(s["prices"]),
    "dim_technology": lambda s: dim_technology(s["innovation"], s["production"]),
    "dim_date": lambda s: dim_date(s),
}


def dimensions(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(silver) for name, build in DIMENSIONS.items()}


# ---- facts ---------------------------------------------------------------------------------


def _by_name(fact: DataFrame, dim: DataFrame, fact_name: str, dim_name: str, key: str) -> DataFrame:
    """Key by a name in any letter case; spellings of one name share the smallest key."""
    named = fact.withColumn("_name", lower_trim(F.col(fact_name)))
    side = dim.select(lower_trim(F.col(dim_name)).alias("_norm"), key)
    return lookup_key(named, side, {"_name": "_norm"}, key, unique=False).drop("_name")


def _by_company(fact: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    """Key of a company given by name or ticker, the same one in every fact."""
    coded = fact.withColumn("_code", lower_trim(company_code(F.col(column))))
    side = dim.select(lower_trim(F.col("ticker")).alias("_norm"), "company_key")
    return lookup_key(coded, side, {"_code": "_norm"}, "company_key", unique=False).drop("_code")


def _dated(fact: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    dated = fact.withColumn("full_date", as_date(fact, column))
    return lookup_key(dated, dim, {"full_date": "full_date"}, "date_key")


def _keyed(fact: DataFrame, key: str, grain: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    return fact.select(surrogate_key(*grain, wide=True).alias(key), *columns)


def fact_ai_demand(demand: DataFrame, market: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Country demand beside the year's market; market-only years keep a NULL country."""
    joined = outer_enrich(demand, market, ["year"])
    keyed = lookup_key(
        _dated(joined, dims["dim_date"], "year"),
        dims["dim_country"],
        {"country": "country_name"},
        "country_key",
    )
    return _keyed(
        keyed,
        "demand_fact_key",
        [F.col("year"), F.col("country")],
        ["date_key", "country_key", *fixed.DEMAND_MEASURES, *fixed.MARKET_MEASURES],
    )


def fact_chip_market_price(prices: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Daily prices; the product is looked up by its whole natural key, so nothing fans out."""
    natural = {"product": "product_name", "category": "category", "unit": "unit"}
    keyed = lookup_key(
        _dated(prices, dims["dim_date"], "date"),
        dims["dim_product"],
        natural,
        "product_key",
        null_safe=True,
    )
    grain = [F.col(c) for c in ("full_date", *natural)]
    return _keyed(keyed, "price_fact_key", grain, ["date_key", "product_key", "price"])


def fact_stock_market(bars: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Daily bars; companies that share a ticker count as one, so nothing fans out."""
    keyed = _by_company(_dated(bars, dims["dim_date"], "date"), dims["dim_company"], "ticker")
    grain = [F.col("full_date"), F.col("ticker")]
    return _keyed(keyed, "stock_fact_key", grain, ["date_key", "company_key", *fixed.BAR_MEASURES])


def fact_semiconductor_production(
    production: DataFrame, innovation: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Production enriched on company, year and node; grain company, country, node, year.

    Several innovation rows of one company, year and node do not multiply production rows.
    """
    base = production.select(
        "year",
        F.col("company").alias("company_name"),
        F.col("country").alias("country_name"),
        F.col("technology_node_nm").alias("node_size_nm"),
        *fixed.PRODUCTION_MEASURES,
    )
    node = F.col("node_size_nm").cast("double")
    joined = enrich(
        base,
        innovation,
        [
            (lower_trim(F.col("company_name")), lower_trim(F.col("company"))),
            (F.col("year"), F.col("year")),
            (node, node),
        ],
        fixed.INNOVATION_MEASURES,
        unique=False,
    )
    keyed = _by_company(joined, dims["dim_company"], "company_name")
    keyed = _by_name(keyed, dims["dim_country"], "country_name", "country_name", "country_key")
    technology = dims["dim_technology"].withColumn("node_size_nm", node)
    keyed = lookup_key(
        keyed.withColumn("_node", node),
        technology,
        {"_node": "node_size_nm"},
        "technology_key",
        unique=False,
    )
    keyed = _dated(keyed, dims["dim_date"], "year")
    names = ["year", "company_name", "country_name", "node_size_nm"]
    return _keyed(
        keyed,
        "production_fact_key",
        [F.col(c) for c in names],
        [
            "date_key",
            "company_key",
            "country_key",
            "technology_key",
            *names,
            *fixed.PRODUCTION_MEASURES,
            *fixed.INNOVATION_MEASURES,
        ],
    )


def fact_semiconductor_supply_risk(
    risk: DataFrame, disruption: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Country risk enriched with the disruption of its region; grain year and country.

    Several spellings of a region do not multiply risk rows.
    """
    base = risk.select(
        "year",
        F.col("country").alias("country_name"),
        lookup_map(F.col("country"), fixed.COUNTRY_REGIONS).alias("region_name"),
        *fixed.RISK_MEASURES,
    )
    joined = enrich(
        base,
        disruption,
        [(F.col("year"), F.col("year")), (F.col("region_name"), lower_trim(F.col("region")))],
        fixed.DISRUPTION_MEASURES,
        unique=False,
    )
    keyed = _by_name(joined, dims["dim_country"], "country_name", "country_name", "country_key")
    keyed = _by_name(keyed, dims["dim_region"], "region_name", "region_name", "region_key")
    keyed = _dated(keyed, dims["dim_date"], "year")
    names = ["year", "country_name", "region_name"]
    return _keyed(
        keyed,
        "risk_fact_key",
        [F.col("year"), F.col("country_name")],
        [
            "date_key",
            "country_key",
            "region_key",
            *names,
            *fixed.RISK_MEASURES,
            *fixed.DISRUPTION_MEASURES,
        ],
    )


#: How each fact is made from silver tables and dimensions, and the dimensions it looks up.
FACTS = {
    "fact_ai_demand": (
        lambda s, dims: fact_ai_demand(s["demand"], s["market"], dims),
        ("dim_date", "dim_country"),
    ),
    "fact_chip_market_price": (
        lambda s, dims: fact_chip_market_price(s["prices"], dims),
        ("dim_date", "dim_product"),
    ),
    "fact_stock_market": (
        lambda s, dims: fact_stock_market(s["bars"], dims),
        ("dim_date", "dim_company"),
    ),
    "fact_semiconductor_production": (
        lambda s, dims: fact_semiconductor_production(s["production"], s["innovation"], dims),
        ("dim_date", "dim_company", "dim_country", "dim_technology"),
    ),
    "fact_semiconductor_supply_risk": (
        lambda s, dims: fact_semiconductor_supply_risk(s["risk"], s["disruption"], dims),
        ("dim_date", "dim_country", "dim_region"),
    ),
}


def facts(silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(silver, dims) for name, (build, _) in FACTS.items()}


def company_year_rollup(production: DataFrame) -> DataFrame:
    """Production per company and year, each measure by its configured aggregate."""
    return rollup(production, ["company", "year"], fixed.PRODUCTION_ROLLUP)


# Checks a caller may run on a finished fact: its grain key and its foreign keys.
FACT_CHECKS = {
    "fact_ai_demand": ("demand_fact_key", ["date_key", "country_key"]),
    "fact_chip_market_price": ("price_fact_key", ["date_key", "product_key"]),
    "fact_stock_market": ("stock_fact_key", ["date_key", "company_key"]),
    "fact_semiconductor_production": (
        "production_fact_key",
        ["date_key", "company_key", "country_key", "technology_key"],
    ),
    "fact_semiconductor_supply_risk": ("risk_fact_key", ["date_key", "country_key", "region_key"]),
}


def fact_checks(spark: SparkSession, lake: str, fact: str) -> dict[str, DataFrame]:
    """Lazy reports on a stored fact: two one-row checks and a few rows to look at."""
    key, foreign_keys = FACT_CHECKS[fact]
    stored = read_table(spark, f"{lake}/{fixed.GOLD_FACTS}/{fact}")
    return {
        "grain": grain_check(stored, [key]),
        "foreign_keys": null_fk_report(stored, foreign_keys),
        "sample": stored.limit(20),
        "null_foreign_keys_sample": null_fk_rows(stored, foreign_keys).limit(5),
    }


def build_gold(
    spark: SparkSession, lake: str, write: Writer = write_table, read: Reader = read_table
) -> dict[str, WriteResult]:
    """Write all dimensions, then all facts.

    With ``write=publish_table, read=read_published`` every table is published by version, so
    a run that fails half-way leaves all tables readable.
    """
    silver = {
        name: read_table(spark, f"{lake}/{path}", recursive=name != "bars")
        for name, path in SILVER_TABLES.items()
    }
    written, dims = {}, {}
    for name, df in dimensions(silver).items():
        path = f"{lake}/{fixed.GOLD_DIMENSIONS}/{name}"
        written[name] = write(df, path)
        dims[name] = read(spark, path)
    for name, df in facts(silver, dims).items():
        written[name] = write(df, f"{lake}/{fixed.GOLD_FACTS}/{name}")
    return written


def gold_path(lake: str, name: str) -> str:
    folder = fixed.GOLD_DIMENSIONS if name in DIMENSIONS else fixed.GOLD_FACTS
    return f"{lake}/{folder}/{name}"


def gold_jobs(
    spark: SparkSession, lake: str, write: Writer = write_table, read: Reader = read_table
) -> dict[str, Job]:
    """A job for every gold table; a fact needs the dimensions it looks up and no others.

    Silver tables are read by the jobs that use them, so a missing one costs only their tables.
    """

    def silver() -> Mapping[str, DataFrame]:
        return TablesOnDemand(
            lambda name: read_table(spark, f"{lake}/{SILVER_TABLES[name]}", recursive=name != "bars")
        )

    def dimension(name: str) -> WriteResult:
        return write(DIMENSIONS[name](silver()), gold_path(lake, name))

    def fact(name: str) -> WriteResult:
        build, needs = FACTS[name]
        dims = {n: read(spark, gold_path(lake, n)) for n in needs}
        return write(build(silver(), dims), gold_path(lake, name))

    jobs = {name: Job(partial(dimension, name)) for name in DIMENSIONS}
    return jobs | {name: Job(partial(fact, name), needs) for name, (_, needs) in FACTS.items()}


def run_gold(
    spark: SparkSession,
    lake: str,
    record: str | None = None,
    width: int = 4,
    write: Writer = write_table,
    read: Reader = read_table,
) -> RunReport:
    """The tables of ``build_gold``, those that do not need each other at the same time.

    Failures are reported and cost only the tables that need the failed one. With ``record``
    a second call goes on where the first one stopped.
    """
    return run_jobs(spark, gold_jobs(spark, lake, write, read), record, width)
