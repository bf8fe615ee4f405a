"""Regression quality in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, target: str | None = None
) -> DataFrame:
    """One row with MAE, RMSE, R² and MAPE.

    Constant actuals score R² 1 when predicted perfectly and 0 otherwise. MAPE is in percent
    over the non-zero actuals, NULL when there are none.
    """
    pairs = df.select(F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p"))
    y, error = F.col("y"), F.col("y") - F.col("p")
    sums = pairs.dropna().agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("var"),
        F.avg(F.when(y != 0, F.abs(error / y))).alias("ape"),
    )
    constant = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return sums.select(
        F.lit(target or actual).alias("target_metric"),
        "mae",
        F.sqrt("mse").alias("rmse"),
        F.when(F.col("var") == 0, constant).otherwise(1 - F.col("mse") / F.col("var")).alias("r2"),
        (F.col("ape") * 100).alias("mape"),
    )
