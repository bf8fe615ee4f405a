"""Dataset schemas, layout, word lists, rules and model settings.

Everything in this module is data that existing inputs and outputs depend on. It must stay
equal for the tables to come out the same.
"""

from __future__ import annotations

# ---- layout of the lake, relative to its root --------------------------------------------

BRONZE_PANELS = "bronze/kaggle"
BRONZE_BARS = "bronze/yahoo"
BRONZE_PRICES = "bronze/trendforce"
SILVER_PANELS = "silver/kaggle"
SILVER_BARS = "silver/yahoo"
SILVER_PRICES = "silver/trendforce"
GOLD_DIMENSIONS = "gold/dimensions"
GOLD_FACTS = "gold/facts"
GOLD_FORECAST = "gold/forecast"

# ---- annual panels: column types and the columns whose outliers are capped ----------------

PANEL_SCHEMAS: dict[str, dict[str, str]] = {
    "1_semiconductor_production": {
        "year": "long",
        "country": "string",
        "company": "string",
        "production_capacity_wafers": "double",
        "fab_count": "long",
        "technology_node_nm": "double",
        "ai_chip_production": "double",
        "foundry_revenue_usd": "double",
        "global_market_share": "double",
    },
    "2_ai_hardware_demand": {
        "year": "long",
        "country": "string",
        "ai_gpu_demand": "double",
        "data_center_count": "long",
        "ai_compute_power": "double",
        "cloud_ai_investment": "double",
        "training_compute_flops": "double",
        "ai_model_count": "long",
    },
    "3_semiconductor_trade_supply_chain": {
        "year": "long",
        "exporting_country": "string",
        "importing_country": "string",
        "chip_export_value_usd": "double",
        "chip_import_value_usd": "double",
        "trade_balance": "double",
        "logistics_route": "string",
        "supply_chain_dependency": "double",
    },
    "4_technology_node_innovation": {
        "year": "long",
        "company": "string",
        "node_size_nm": "double",
        "transistor_density": "double",
        "rd_spending_usd": "double",
        "patent_count": "long",
        "ai_chip_performance": "double",
        "energy_efficiency": "double",
    },
    "5_geopolitical_risk_sanctions": {
        "year": "long",
        "country": "string",
        "export_control_level": "double",
        "sanctions_index": "double",
        "trade_tension_level": "double",
        "military_tech_influence": "double",
        "semiconductor_security_risk": "double",
    },
    "6_supply_chain_disruption": {
        "year": "long",
        "region": "string",
        "natural_disaster_risk": "double",
        "energy_supply_risk": "double",
        "water_shortage_risk": "double",
        "factory_shutdown_risk": "double",
        "supply_disruption_index": "double",
    },
    "7_semiconductor_market_economics": {
        "year": "long",
        "global_semiconductor_revenue": "double",
        "ai_chip_revenue": "double",
        "consumer_electronics_demand": "double",
        "automotive_chip_demand": "double",
        "chip_price_index": "double",
        "market_growth_rate": "double",
    },
}

PANEL_OUTLIERS: dict[str, list[str]] = {
    "1_semiconductor_production": [
        "production_capacity_wafers",
        "foundry_revenue_usd",
        "ai_chip_production",
    ],
    "2_ai_hardware_demand": ["ai_gpu_demand", "cloud_ai_investment", "training_compute_flops"],
    "3_semiconductor_trade_supply_chain": [
        "chip_export_value_usd",
        "chip_import_value_usd",
        "trade_balance",
    ],
    "4_technology_node_innovation": [
        "rd_spending_usd",
        "transistor_density",
        "ai_chip_performance",
    ],
    "5_geopolitical_risk_sanctions": [
        "sanctions_index",
        "trade_tension_level",
        "semiconductor_security_risk",
    ],
    "6_supply_chain_disruption": ["supply_disruption_index"],
    "7_semiconductor_market_economics": [
        "global_semiconductor_revenue",
        "ai_chip_revenue",
        "chip_price_index",
    ],
}

OUTLIER_STDDEVS = 3.0

# Columns whose values carry a unit marker: {dataset: {column: unit}}.
PANEL_UNIT_SUFFIXES = {"1_semiconductor_production": {"technology_node_nm": "nm"}}

# ---- daily bars and price observations ----------------------------------------------------

BAR_COLUMNS = ["Date", "Ticker", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
PRICE_COLUMNS = ["Date", "Product", "Price", "Unit", "Category"]
MOVING_AVERAGES = {"ma_5": 5, "ma_20": 20}

UNIT_VARIANTS = {
    "gb": "Gb",
    "gbit": "Gb",
    "gigabit": "Gb",
    "gib": "GiB",
    "gigabyte": "GiB",
    "mb": "Mb",
    "per unit": "unit",
    "/unit": "unit",
    "unit": "unit",
    "usd": "USD",
    "us$": "USD",
    "$": "USD",
    "u.s. dollar": "USD",
}

# ---- gold rules ----------------------------------------------------------------------------

# First rule that occurs in the upper-cased company name wins.
COMPANY_TICKER_RULES = [
    ("NVIDIA", "NVDA"),
    ("ADVANCED MICRO", "AMD"),
    ("INTEL", "INTC"),
    ("BROADCOM", "AVGO"),
    ("MICRON", "MU"),
    ("QUALCOMM", "QCOM"),
    ("TAIWAN SEMI", "TSM"),
]

# Company names as the panels spell them.
COMPANY_TICKERS = {
    "nvidia": "NVDA",
    "amd": "AMD",
    "intel": "INTC",
    "qualcomm": "QCOM",
    "broadcom": "AVGO",
    "tsmc": "TSM",
    "micron": "MU",
}

COUNTRY_REGIONS = {
    "japan": "east asia",
    "taiwan": "east asia",
    "china": "east asia",
    "uk": "europe",
    "switzerland": "europe",
    "germany": "europe",
    "israel": "middle east",
    "netherlands": "europe",
    "usa": "north america",
    "south korea": "east asia",
    "romania": "europe",
    "brazil": "south america",
    "vietnam": "southeast asia",
    "austria": "europe",
    "canada": "north america",
    "saudi arabia": "middle east",
    "finland": "europe",
    "denmark": "europe",
    "mexico": "north america",
    "norway": "europe",
    "sweden": "europe",
    "australia": "oceania",
    "czech republic": "europe",
    "singapore": "southeast asia",
    "belgium": "europe",
    "thailand": "southeast asia",
    "chile": "south america",
    "hungary": "europe",
    "indonesia": "southeast asia",
    "spain": "europe",
    "poland": "europe",
    "uae": "middle east",
    "philippines": "southeast asia",
    "argentina": "south america",
    "malaysia": "southeast asia",
    "south africa": "africa",
    "india": "south asia",
    "italy": "europe",
    "ireland": "europe",
    "france": "europe",
}

# Rollup of production to company and year.
PRODUCTION_ROLLUP = {
    "production_capacity_wafers": "avg",
    "fab_count": "max",
    "ai_chip_production": "sum",
    "foundry_revenue_usd": "sum",
    "global_market_share": "avg",
}

PRODUCTION_MEASURES = [
    "production_capacity_wafers",
    "fab_count",
    "ai_chip_production",
    "foundry_revenue_usd",
    "global_market_share",
]
INNOVATION_MEASURES = [
    "transistor_density",
    "rd_spending_usd",
    "patent_count",
    "ai_chip_performance",
    "energy_efficiency",
]
RISK_MEASURES = [
    "export_control_level",
    "sanctions_index",
    "trade_tension_level",
    "military_tech_influence",
    "semiconductor_security_risk",
]
DISRUPTION_MEASURES = [
    "natural_disaster_risk",
    "energy_supply_risk",
    "water_shortage_risk",
    "factory_shutdown_risk",
    "supply_disruption_index",
]
DEMAND_MEASURES = [
    "ai_gpu_demand",
    "data_center_count",
    "ai_compute_power",
    "cloud_ai_investment",
    "training_compute_flops",
    "ai_model_count",
]
MARKET_MEASURES = [
    "global_semiconductor_revenue",
    "ai_chip_revenue",
    "consumer_electronics_demand",
    "automotive_chip_demand",
    "chip_price_index",
    "market_growth_rate",
]
BAR_MEASURES = [
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "volume",
    "daily_return",
    "volatility_range",
    "ma_5",
    "ma_20",
]

# ---- forecast ------------------------------------------------------------------------------

FORECAST_TARGETS = ["ai_gpu_demand", "ai_chip_revenue"]
DEMAND_FEATURES = [
    "data_center_count",
    "ai_compute_power",
    "cloud_ai_investment",
    "training_compute_flops",
    "ai_model_count",
    "global_semiconductor_revenue",
    "consumer_electronics_demand",
    "automotive_chip_demand",
    "chip_price_index",
    "market_growth_rate",
]
PRODUCTION_FEATURES = PRODUCTION_MEASURES + INNOVATION_MEASURES
LAG_FEATURES = ["ai_gpu_demand_lag_1", "ai_chip_revenue_lag_1"]
FORECAST_FEATURES = ["year", *DEMAND_FEATURES, *PRODUCTION_FEATURES, *LAG_FEATURES]
FORECAST_YEARS = [2026, 2027, 2028, 2029, 2030]
TEST_FRACTION = 0.2
GROWTH_BOUNDS = (-0.5, 1.5)
MODEL_SETTINGS = {
    "trees": 400,
    "depth": 6,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "feature_share": 0.8,
    "seed": 42,
}
