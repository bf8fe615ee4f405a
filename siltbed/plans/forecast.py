"""Gold to forecast: training panel, growth models, recursive forecast, four tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from siltbed.operators.dimensional import union_all
from siltbed.operators.features import (
    chronological_split,
    impute_medians,
    lag_and_growth,
    latest_snapshot,
    numeric_features,
)
from siltbed.operators.forecast import (
    evaluate_model,
    feature_importance,
    forecast_table,
    global_summary,
    model_predictor,
    recursive_forecast,
    train_growth_model,
)
from siltbed.operators.projection import select_once
from siltbed.operators.quality import require
from siltbed.operators.rollup import average_panel
from siltbed.plans import fixed_values as fixed
from siltbed.sources.readers import read_table
from siltbed.sources.session import staged
from siltbed.sources.writers import Reader, Writer, WriteResult, write_table

GOLD_TABLES = {
    **{
        d: f"{fixed.GOLD_DIMENSIONS}/{d}"
        for d in (
            "dim_company",
            "dim_country",
            "dim_date",
            "dim_product",
            "dim_region",
            "dim_technology",
        )
    },
    **{
        f: f"{fixed.GOLD_FACTS}/{f}"
        for f in (
            "fact_ai_demand",
            "fact_chip_market_price",
            "fact_semiconductor_production",
            "fact_semiconductor_supply_risk",
            "fact_stock_market",
        )
    },
}


def training_panel(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Demand with its year, the country's average production of that year and its name."""
    production = average_panel(
        tables["fact_semiconductor_production"], ["country_key", "year"], fixed.PRODUCTION_FEATURES
    )
    panel = (
        tables["fact_ai_demand"]
        .join(tables["dim_date"].select("date_key", "year"), "date_key", "left")
        .join(production, ["country_key", "year"], "left")
        .join(tables["dim_country"].select("country_key", "country_name"), "country_key", "left")
    )
    return select_once(
        panel,
        [
            "date_key",
            "country_key",
            "country_name",
            "year",
            *fixed.DEMAND_FEATURES,
            *fixed.PRODUCTION_FEATURES,
            *fixed.FORECAST_TARGETS,
        ],
    )


def prepare_panel(panel: DataFrame, key: str = "country_key") -> DataFrame:
    """Numbers, medians, lags and growth; rows without a target level are dropped."""
    exogenous = [*fixed.DEMAND_FEATURES, *fixed.PRODUCTION_FEATURES]
    return (
        staged(numeric_features(panel, [*exogenous, *fixed.FORECAST_TARGETS, "year"]))
        .transform(impute_medians, key, exogenous)
        .transform(lag_and_growth, key, "year", fixed.FORECAST_TARGETS, fixed.GROWTH_BOUNDS)
        .transform(require, fixed.FORECAST_TARGETS)
    )


def forecast_tables(
    spark: SparkSession,
    panel: DataFrame,
    years: Sequence[int] = tuple(fixed.FORECAST_YEARS),
    settings: Mapping[str, float] | None = None,
    key: str = "country_key",
    name: str = "country_name",
    feedback_scale: float = 1.0,
) -> dict[str, DataFrame]:
    """Evaluation, feature importance, per-key forecast and global summary.

    The prepared panel is staged once: both models and the snapshot read it, and a lost
    executor must not cause its joins to run again.
    """
    prepared = staged(prepare_panel(panel, key))
    split = chronological_split(prepared, "year", fixed.TEST_FRACTION)
    train, test = split.filter("is_train"), split.filter("NOT is_train")

    models, evaluations, importances = {}, [], []
    for target in fixed.FORECAST_TARGETS:
        growth = f"{target}_yoy_growth"
        model = train_growth_model(
            train, fixed.FORECAST_FEATURES, growth, **(settings or fixed.MODEL_SETTINGS)
        )
        models[target] = model_predictor(model)
        evaluations.append(evaluate_model(model, test, fixed.FORECAST_FEATURES, growth))
        importances.append(feature_importance(spark, model, fixed.FORECAST_FEATURES, growth))

    snapshot = latest_snapshot(prepared, key, "year", fixed.FORECAST_TARGETS)
    forecast = recursive_forecast(
        snapshot,
        [key, name],
        models,
        years,
        features=fixed.FORECAST_FEATURES,
        feedback={"market_growth_rate": "ai_chip_revenue"},
        feedback_scale=feedback_scale,
    )
    return {
        "evaluation": union_all(evaluations),
        "feature_importance": union_all(importances),
        "forecast_country": forecast_table(forecast, key, name),
        "forecast_global": global_summary(forecast),
    }


def run_forecast(
    spark: SparkSession, lake: str, write: Writer = write_table, read: Reader = read_table, **options
) -> dict[str, WriteResult]:
    """Read gold, forecast, write the four tables. ``write`` and ``read`` as in ``build_gold``."""
    tables = {name: read(spark, f"{lake}/{path}") for name, path in GOLD_TABLES.items()}
    results = forecast_tables(spark, training_panel(tables), **options)
    return {
        name: write(df, f"{lake}/{fixed.GOLD_FORECAST}/{name}")
        for name, df in results.items()
    }
