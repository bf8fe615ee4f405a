"""Panel features against a pandas rendering, metrics and recursive forecasts."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltbed.operators import features as f
from siltbed.operators import forecast as fc
from siltbed.operators.metrics import regression_metrics

SCHEMA = "country string, year int, gpu double, rev double, a double, b string"


def panel_rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for country in ("x", "y", "z", "w", None):
        for year in range(2010, 2022):
            gap = lambda p, v: None if rng.random() < p else v
            a = None if country == "w" else gap(0.4, round(rng.uniform(1, 9), 2))
            rows.append(
                (
                    country,
                    year,
                    gap(0.2, rng.choice([0.0, round(rng.uniform(50, 500), 2)])),
                    gap(0.1, round(rng.uniform(5, 50), 2)),
                    a,
                    gap(0.2, rng.choice(["3.5", "junk", "7", "NaN"])),
                )
            )
    return rows


def expected(rows):
    """Imputation, lags and growth, written with pandas."""
    pdf = pd.DataFrame(rows, columns=["country", "year", "gpu", "rev", "a", "b"])
    pdf["gone"] = np.nan
    for c in ("a", "b", "gone"):
        pdf[c] = pd.to_numeric(pdf[c], errors="coerce")
        filled = pdf[c].fillna(pdf.groupby("country")[c].transform("median"))
        pdf[c] = filled.where(pdf["country"].notna())
        pdf[c] = pdf[c].fillna(pdf[c].median()).fillna(0.0)
    pdf = pdf.sort_values(["country", "year"]).reset_index(drop=True)
    for t in ("gpu", "rev"):
        by = pdf.groupby("country")
        pdf["lag"] = by[t].shift(1)
        lag = pdf.groupby("country")["lag"].bfill()
        pdf["lag"] = lag
        lag = pdf.groupby("country")["lag"].ffill()
        lag = lag.where(pdf["country"].isna(), lag.fillna(0.0))
        pdf[f"{t}_lag_1"] = lag.where(pdf["country"].notna())
        with np.errstate(all="ignore"):
            growth = np.where(lag != 0, (pdf[t] - lag) / lag, 0.0)
        pdf[f"{t}_yoy_growth"] = pd.Series(growth).clip(-0.5, 1.5).fillna(0.0)
        pdf = pdf.drop(columns="lag")
    return pdf


@pytest.mark.parametrize("width", [None, 1, 4])
def test_preparation_equals_pandas(frame, width):
    rows = panel_rows()
    slice_by = None if width is None else F.floor(F.col("year") / width)
    df = frame(rows, SCHEMA).repartition(3)
    got = (
        df.transform(f.numeric_features, ["a", "b", "gone"])
        .transform(f.impute_medians, "country", ["a", "b", "gone"])
        .transform(f.lag_and_growth, "country", "year", ["gpu", "rev"], slice_by=slice_by)
        .toPandas()
    )
    want = expected(rows)
    assert len(got) == len(want)
    for pdf in (got, want):
        pdf["country"] = pdf["country"].fillna("-").astype(object)
    key = ["country", "year"]
    got, want = got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[sorted(want.columns)], want[sorted(want.columns)], check_dtype=False)


def test_rows_without_key_are_spread(frame):
    df = frame([(None, 1, 5.0), ("k", 1, 5.0), ("k", 2, 10.0)], "k string, y int, t double")
    got = {(r.k, r.y): (r.t_lag_1, r.t_yoy_growth) for r in f.lag_and_growth(df, "k", "y", ["t"]).collect()}
    assert got == {(None, 1): (None, 0.0), ("k", 1): (5.0, 0.0), ("k", 2): (5.0, 1.0)}


@pytest.mark.parametrize("slices", [1, 4, 256])
def test_category_codes(frame, slices):
    values = [f"name {i:04d}" for i in range(300)]
    rng = random.Random(2)
    rows = [(rng.choice(values + [None] * 20),) for _ in range(2000)]
    order = {v: i for i, v in enumerate(sorted({r[0] for r in rows if r[0] is not None}))}
    got = f.category_codes(frame(rows, "v string").repartition(4), "v", "code", slices)
    pairs = [(r.v, r.code) for r in got.collect()]
    assert len(pairs) == len(rows)
    assert all(code == order.get(v, -1) for v, code in pairs)


@pytest.mark.parametrize("years, train", [(1, 1), (2, 1), (3, 2), (5, 4), (7, 5), (10, 8), (11, 8)])
def test_chronological_split(frame, years, train):
    df = frame([(y, i) for y in range(2000, 2000 + years) for i in range(2)], "year int, i int")
    got = f.chronological_split(df, "year").collect()
    assert {r.year for r in got if r.is_train} == set(range(2000, 2000 + train))
    assert len(got) == 2 * years


def test_latest_snapshot(frame):
    rows = [("a", 1, 5.0), ("a", 2, 7.0), ("a", 2, 6.0), ("b", 1, 1.0), (None, 2, 3.0)]
    got = f.latest_snapshot(frame(rows, "k string, y int, t double"), "k", "y", ["t"])
    assert {tuple(r) for r in got.collect()} == {("a", 2, 6.0, 6.0), (None, 2, 3.0, 3.0)}


def metrics(frame, pairs):
    return regression_metrics(frame(pairs, "y double, p double"), "y", "p", "t").first()


def test_regression_metrics(frame):
    row = metrics(frame, [(1.0, 2.0), (0.0, 1.0), (4.0, 2.0), (None, 9.0)])
    assert (row.target_metric, row.mae) == ("t", pytest.approx(4 / 3))
    assert row.rmse == pytest.approx(2**0.5)
    assert row.r2 == pytest.approx(1 - 6 / (26 / 3))
    assert row.mape == pytest.approx(75.0)


def test_metrics_of_constant_and_zero_actuals(frame):
    assert metrics(frame, [(2.0, 2.0), (2.0, 2.0)]).r2 == 1.0
    assert metrics(frame, [(2.0, 3.0), (2.0, 2.0)]).r2 == 0.0
    assert metrics(frame, [(0.0, 1.0), (0.0, 2.0)]).mape is None


def test_constant_growth_compounds(frame):
    start = frame([("a", 2020, 100.0, 10.0, 1.0, 1.0, 0.0)], "k string, year int, gpu double, rev double, gpu_lag_1 double, rev_lag_1 double, m double")
    rules = {"gpu": fc.column_predictor(F.lit(0.1)), "rev": fc.column_predictor(F.lit(0.5))}
    got = fc.recursive_forecast(start, ["k"], rules, [2021, 2022, 2023]).orderBy("forecast_year").collect()
    assert [r.forecast_year for r in got] == [2021, 2022, 2023]
    assert [r.predicted_gpu for r in got] == pytest.approx([110.0, 121.0, 133.1])
    assert [r.predicted_rev for r in got] == pytest.approx([15.0, 22.5, 33.75])


def test_state_rolls_between_steps(frame):
    start = frame([("a", 2020, 100.0, 80.0, 0.2)], "k string, year int, v double, v_lag_1 double, m double")
    rule = F.col("m") / 2 + (F.col("v") / F.col("v_lag_1") - 1) + (F.col("year") - 2020) / 100
    got = fc.recursive_forecast(
        start, ["k"], {"v": fc.column_predictor(rule)}, [2021, 2022, 2023], feedback={"m": "v"}, feedback_scale=0.5
    )
    v, lag, m, want = 100.0, 80.0, 0.2, []
    for year in (2021, 2022, 2023):
        g = m / 2 + (v / lag - 1) + (year - 2020) / 100
        v, lag, m = v * (1 + g), v, g * 0.5
        want.append(v)
    assert [r.predicted_v for r in got.orderBy("forecast_year").collect()] == pytest.approx(want)


def test_forecast_plan_is_one_narrow_pass(spark, frame):
    start = frame([("a", 2020, 1.0, 1.0)], "k string, year int, v double, v_lag_1 double")
    rule = {"v": fc.column_predictor(F.col("v_lag_1") / 10)}
    plan = fc.recursive_forecast(start, ["k"], rule, list(range(2021, 2031)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Union" not in plan


def test_boosted_model_learns_and_forecasts(spark, frame):
    rng = random.Random(1)
    rows = [(float(x), rng.random(), 0.5 if x > 50 else -0.2) for x in range(100)]
    df = frame(rows, "x double, noise double, g double")
    model = fc.train_growth_model(df, ["x", "noise"], "g", trees=5, depth=2, learning_rate=0.5)
    row = fc.evaluate_model(model, df, ["x", "noise"], "g").first()
    assert row.r2 > 0.9 and row.target_metric == "g"
    importance = fc.feature_importance(spark, model, ["x", "noise"], "g").collect()
    assert [r.feature_name for r in importance][0] == "x"
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    start = frame([("k", 1, 80.0, None, 10.0)], "k string, year int, x double, noise double, v double")
    forecast = fc.recursive_forecast(
        start, ["k"], {"v": fc.model_predictor(model)}, [2, 3], features=["x", "noise"]
    )
    first, second = forecast.orderBy("forecast_year").collect()
    growth = first.predicted_v / 10 - 1
    assert growth == pytest.approx(0.5, abs=0.1)
    assert second.predicted_v == pytest.approx(10 * (1 + growth) ** 2)


def test_forecast_outputs(frame):
    rows = [(2026, 1, "b", 5.0, 10.0), (2027, 1, "b", 6.0, 20.0), (2026, 2, "a", 1.0, 0.0), (2027, 2, "a", 2.0, 5.0)]
    df = frame(rows, "forecast_year int, country_key bigint, country_name string, predicted_ai_gpu_demand double, predicted_ai_chip_revenue double")
    table = fc.forecast_table(df, "country_key", "country_name")
    assert [(r.forecast_year, r.country_name, r.predicted_market_growth_rate) for r in table.collect()] == [
        (2026, "a", 0.0),
        (2026, "b", 0.0),
        (2027, "a", 0.0),
        (2027, "b", 1.0),
    ]
    total = [tuple(r) for r in fc.global_summary(df).collect()]
    assert total == [(2026, 6.0, 10.0, 0.0), (2027, 8.0, 25.0, pytest.approx(1.5))]


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_lags_of_tied_rows_do_not_depend_on_partitions(frame, partitions):
    rows = [("x", 2000, float(i), i % 3) for i in range(9)] + [("x", 2001, 5.0, 1), ("x", 2001, 6.0, 2)]
    want = None
    for seed in (0, 5):
        df = frame(rows[seed:] + rows[:seed], "country string, year int, gpu double, id int").repartition(partitions)
        got = sorted(map(tuple, f.lag_and_growth(df, "country", "year", ["gpu"]).collect()))
        want = want or got
        assert got == want


def test_split_of_many_periods(spark):
    """Periods are numbered in slices: no aggregate holds them all."""
    panel = spark.range(300_000).select((F.col("id") * 7919 % 100_003).alias("period"))
    split = f.chronological_split(panel, "period", 0.25)
    counts = split.groupBy("is_train").agg(F.countDistinct("period").alias("n"), F.max("period").alias("last"))
    got = {r.is_train: (r.n, r["last"]) for r in counts.collect()}
    cut = 100_003 * 3 // 4
    assert got == {True: (cut, cut - 1), False: (100_003 - cut, 100_002)}


@pytest.mark.parametrize("periods, train", [([], []), ([None], [None]), ([4], [True]), ([4, 4, None], [True, True, None]), ([4, 5], [True, False]), (["b", "a", "c"], [True, True, False])])
def test_split_of_few_periods(frame, periods, train):
    kind = "string" if "a" in periods else "int"
    split = f.chronological_split(frame([(p,) for p in periods], f"period {kind}"), "period", 0.2)
    got = sorted(((r.period is None, r.period, r.is_train) for r in split.collect()), key=str)
    expected = sorted(((p is None, p, t) for p, t in zip(sorted(periods, key=str), train)), key=str)
    assert got == expected
