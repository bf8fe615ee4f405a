"""Growth models on ``pyspark.ml`` and recursive multi-step forecasts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.metrics import regression_metrics
from siltbed.operators.rollup import compound_growth
from siltbed.operators.timeseries import percent_change
from siltbed.operators.trees import forest_size, score_trees

# A predictor adds its prediction to the frame under the given name.
Predictor = Callable[[DataFrame, str], DataFrame]


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector in ``_features``; a missing value counts as 0, like a missing lag."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    return df.withColumn("_features", array_to_vector(F.array(*values)))


def train_growth_model(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    trees: int = 400,
    depth: int = 6,
    learning_rate: float = 0.05,
    subsample: float = 0.8,
    feature_share: float = 0.8,
    seed: int = 42,
) -> GBTRegressionModel:
    """Gradient-boosted trees on one growth target, trained on the cluster.

    The feature share applies per node, and there is no L1/L2 penalty: scores are close to,
    not bit-equal with, other boosting libraries.
    """
    booster = GBTRegressor(
        featuresCol="_features",
        labelCol=target,
        predictionCol="_prediction",
        maxIter=trees,
        maxDepth=depth,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(feature_share),
        seed=seed,
    )
    return booster.fit(assemble(train, features).select("_features", target))


def model_predictor(model: GBTRegressionModel) -> Predictor:
    """Predictor from a model; the frame holds the assembled ``_features``."""
    return lambda df, out: model.transform(df, {model.predictionCol: out})


def tree_predictor(trees: DataFrame, features: Sequence[str]) -> Predictor:
    """Predictor from a table of trees (``operators.trees``); reads the features by name."""
    size = forest_size(trees)
    return lambda df, out: score_trees(df, trees, features, out, size=size)


def column_predictor(growth: Column) -> Predictor:
    """Predictor from an expression, e.g. a per-key historical mean growth."""
    return lambda df, out: df.withColumn(out, growth)


def evaluate_model(
    model: GBTRegressionModel, test: DataFrame, features: Sequence[str], target: str
) -> DataFrame:
    scored = model_predictor(model)(assemble(test, features), "_predicted")
    return regression_metrics(scored, target, "_predicted", target)


def feature_importance(
    spark: SparkSession, model: GBTRegressionModel, features: Sequence[str], target: str
) -> DataFrame:
    """Importance per feature, largest first; one row per feature."""
    weights = model.featureImportances.toArray()
    rows = [(f, float(w), target) for f, w in zip(features, weights)]
    schema = "feature_name string, importance double, target_metric string"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature_name")


def recursive_forecast(
    snapshot: DataFrame,
    keys: Sequence[str],
    predictors: Mapping[str, Predictor],
    years: Sequence[int],
    period: str = "year",
    features: Sequence[str] | None = None,
    feedback: Mapping[str, str] | None = None,
    feedback_scale: float = 1.0,
) -> DataFrame:
    """Forecast levels year by year, each step feeding the next.

    ``predictors`` give a growth rate per target level; ``features`` are assembled once per
    step for those that are models. A step compounds the levels, rolls ``<target>_lag_1``
    and, for ``feedback={feature: target}``, stores the predicted growth (times
    ``feedback_scale``) as that feature for the next step.

    The whole horizon is one narrow chain of projections over one row per key: no shuffle,
    no job per step and no lineage to cut. The steps become rows in a last explode.
    """
    columns = list(dict.fromkeys([*snapshot.columns, *[f"{t}_lag_1" for t in predictors], *(feedback or {})]))
    kind = snapshot.schema[period].dataType
    state, steps = snapshot, []
    for i, year in enumerate(years):
        state = state.withColumn(period, F.lit(year).cast(kind))
        if features:
            state = assemble(state, features)
        for target, predict in predictors.items():
            state = predict(state, f"_growth_{target}")
        level = {t: F.col(t) * (1 + F.col(f"_growth_{t}")) for t in predictors}
        step = F.struct(
            F.lit(year).cast("int").alias("forecast_year"),
            *[c.alias(f"predicted_{t}") for t, c in level.items()],
        )
        changed = {f"{t}_lag_1": F.col(t) for t in predictors} | level
        changed |= {f: F.col(f"_growth_{t}") * feedback_scale for f, t in (feedback or {}).items()}
        state = state.select(
            *[changed[c].alias(c) if c in changed else F.col(c) for c in columns],
            *steps,
            step.alias(f"_step_{i}"),
        )
        steps.append(f"_step_{i}")
    return state.select(*keys, F.inline(F.array(*steps)))


def forecast_table(
    forecast: DataFrame,
    key: str,
    name: str,
    value: str = "predicted_ai_chip_revenue",
    out: str = "predicted_market_growth_rate",
) -> DataFrame:
    """Per-key forecast with its own growth, by year and name.

    A key has one row per forecast year, so its window is as long as the horizon.
    """
    changed = percent_change(forecast, [key], ["forecast_year"], value, out)
    measures = [c for c in forecast.columns if c not in ("forecast_year", key, name)]
    return changed.select("forecast_year", key, name, *measures, out).orderBy(
        "forecast_year", name, key
    )


def global_summary(
    forecast: DataFrame,
    units: str = "predicted_ai_gpu_demand",
    value: str = "predicted_ai_chip_revenue",
) -> DataFrame:
    """Totals per forecast year with compound growth against the first year."""
    yearly = forecast.groupBy("forecast_year").agg(
        F.sum(units).alias("global_unit_demand"), F.sum(value).alias("global_market_value")
    )
    return compound_growth(yearly, "forecast_year", "global_market_value").orderBy("forecast_year")
