"""Growth models and recursive forecasts over the annual panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.dimensional import union_all
from siltbed.operators.features import (
    chronological_split,
    impute_medians,
    lag_and_growth,
    latest_snapshot,
)
from siltbed.operators.forecast import (
    column_predictor,
    forecast_table,
    global_summary,
    recursive_forecast,
    train_growth_model,
    tree_predictor,
)
from siltbed.operators.metrics import regression_metrics
from siltbed.operators.trees import read_trees, score_trees, store_trees, tree_importance
from siltbed.sources.session import staged, staging_path
from siltbed.workload.panel import EXOGENOUS, GROWTH_SQL, PANEL_SQL, TARGETS, panel
from siltbed.workload.registry import query, rounded

FEATURES = ["year", *EXOGENOUS, *[f"{t}_lag_1" for t in TARGETS]]
YEARS = [2002, 2003, 2004, 2005, 2006]
KEYS = ["nation_key", "nation_name"]


# ---- recursion with a transparent growth rule ----------------------------------------------

# Value growth mixes the nation's mean with the growth fed back from the step before; count
# growth mixes its mean with the momentum of the rolled lag.
FORECAST_SQL = f"""
WITH RECURSIVE {PANEL_SQL}, {GROWTH_SQL},
means AS (
  SELECT nation_key, avg(order_value_yoy_growth) AS mv, avg(order_count_yoy_growth) AS mc
  FROM grown WHERE nation_key IS NOT NULL GROUP BY nation_key),
steps AS (
  SELECT nation_key, nation_name, 2001 AS forecast_year, order_value AS v, order_count AS c,
         order_count AS cl, 0.04::DOUBLE AS market, coalesce(mv, 0) AS mv, coalesce(mc, 0) AS mc
  FROM panel LEFT JOIN means USING (nation_key) WHERE year = (SELECT max(year) FROM panel)
  UNION ALL
  SELECT nation_key, nation_name, forecast_year + 1, v * (1 + 0.5 * mv + 0.5 * market),
         c * (1 + 0.5 * mc + 0.1 * (c / cl - 1)), c, 0.5 * mv + 0.5 * market, mv, mc
  FROM steps WHERE forecast_year < 2006),
forecast AS (
  SELECT forecast_year, nation_key, nation_name, v AS predicted_order_value, c AS predicted_order_count
  FROM steps WHERE forecast_year > 2001)"""


def _rule_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = staged(lag_and_growth(panel(spark, sf_dir), "nation_key", "year", TARGETS))
    means = (
        grown.dropna(subset=["nation_key"])
        .groupBy("nation_key")
        .agg(*[F.avg(f"{t}_yoy_growth").alias(f"mean_{t}") for t in TARGETS])
    )
    # Rows without a nation stay in the totals; they have no series and so no mean growth.
    mean_columns = [f"mean_{t}" for t in TARGETS]
    snapshot = (
        latest_snapshot(grown, "nation_key", "year", TARGETS)
        .join(means, "nation_key", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in mean_columns})
        .withColumn("market_growth", F.lit(0.04))
    )
    momentum = F.coalesce(F.col("order_count") / F.col("order_count_lag_1") - 1, F.lit(0.0))
    rules = {
        "order_value": column_predictor(0.5 * F.col("mean_order_value") + 0.5 * F.col("market_growth")),
        "order_count": column_predictor(0.5 * F.col("mean_order_count") + 0.1 * momentum),
    }
    return recursive_forecast(snapshot, KEYS, rules, YEARS, feedback={"market_growth": "order_value"})


@query(f"""{FORECAST_SQL},
prior AS (
  SELECT *, lag(predicted_order_value) OVER (PARTITION BY nation_key ORDER BY forecast_year) AS b FROM forecast)
SELECT forecast_year, nation_key, nation_name, round(predicted_order_value, 2) + 0.0 AS predicted_order_value,
       round(predicted_order_count, 4) + 0.0 AS predicted_order_count,
       round(coalesce(CASE WHEN b <> 0 THEN (predicted_order_value - b) / b END, 0), 6) + 0.0 AS growth
FROM prior""")
def recursive_growth_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = _rule_forecast(spark, sf_dir)
    shaped = forecast_table(forecast, *KEYS, value="predicted_order_value", out="growth")
    shaped = rounded(shaped, ["predicted_order_value"], 2)
    return rounded(rounded(shaped, ["predicted_order_count"], 4), ["growth"])


@query(f"""{FORECAST_SQL},
yearly AS (
  SELECT forecast_year, sum(predicted_order_count) AS units, sum(predicted_order_value) AS value
  FROM forecast GROUP BY forecast_year)
SELECT forecast_year, round(units, 2) + 0.0 AS global_unit_demand, round(value, 2) + 0.0 AS global_market_value,
       round(CASE WHEN forecast_year > 2002 THEN pow(value / (SELECT value FROM yearly WHERE forecast_year = 2002),
             1.0 / (forecast_year - 2002)) - 1 ELSE 0 END, 8) + 0.0 AS cagr
FROM yearly""")
def global_cagr(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = global_summary(
        _rule_forecast(spark, sf_dir), "predicted_order_count", "predicted_order_value"
    )
    return rounded(rounded(summary, ["global_unit_demand", "global_market_value"], 2), ["cagr"], 8)


# ---- boosted trees -------------------------------------------------------------------------

# Few trees keep the queries short; the job's default is the full number.
SETTINGS = {"trees": 10, "depth": 4, "learning_rate": 0.1}

#: Folder of the trained models, by application and digest of the panel they were trained on.
_TRAINED: dict[tuple[str, int, int], str] = {}


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The prepared panel and the trees of each target as tables.

    The panel is made from the tables in every call. Models are trained once per session for
    a panel with the same rows, so changed tables train anew.
    """
    imputed = impute_medians(staged(panel(spark, sf_dir)), "nation_key", EXOGENOUS)
    prepared = staged(imputed.transform(lag_and_growth, "nation_key", "year", TARGETS))
    digest = F.xxhash64(*sorted(prepared.columns))
    rows, content = prepared.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(digest), F.lit(0))).first()
    key = (spark.sparkContext.applicationId, rows, content)
    if key not in _TRAINED:
        folder = staging_path(spark)
        train = chronological_split(prepared, "year").filter("is_train")
        for t in TARGETS:
            store_trees(train_growth_model(train, FEATURES, f"{t}_yoy_growth", **SETTINGS), f"{folder}/{t}")
        _TRAINED[key] = folder
    return prepared, {t: read_trees(spark, f"{_TRAINED[key]}/{t}") for t in TARGETS}


@query()
def gbt_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, trees = _trained(spark, sf_dir)
    test = chronological_split(prepared, "year").filter("NOT is_train")
    return union_all(
        [
            regression_metrics(
                score_trees(test, table, FEATURES, "_predicted"), f"{t}_yoy_growth", "_predicted", f"{t}_yoy_growth"
            )
            for t, table in trees.items()
        ]
    )


@query()
def gbt_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, trees = _trained(spark, sf_dir)
    return union_all([tree_importance(table, FEATURES, f"{t}_yoy_growth") for t, table in trees.items()])


@query()
def gbt_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, trees = _trained(spark, sf_dir)
    snapshot = latest_snapshot(prepared, "nation_key", "year", TARGETS)
    predictors = {t: tree_predictor(table, FEATURES) for t, table in trees.items()}
    forecast = recursive_forecast(snapshot, KEYS, predictors, YEARS)
    return forecast_table(forecast, *KEYS, value="predicted_order_value", out="growth")
