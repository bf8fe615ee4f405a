"""Filters, duplicates, outliers, reports, exact quantiles."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from siltbed.operators import quality as q
from siltbed.operators import quantiles
from siltbed.operators.quantiles import exact_medians, exact_percentiles


def test_null_filters(frame):
    df = frame([(1, None), (None, None), (None, 2)], "a int, b int")
    assert q.drop_all_null(df).count() == 2
    assert [tuple(r) for r in q.require(df, ["a"]).collect()] == [(1, None)]
    assert df.filter(q.any_null(["a", "b"])).count() == 3
    assert df.filter(q.any_null([])).count() == 0


def test_dedupe(frame):
    rows = [(1, "b", 2.0), (1, "a", None), (1, "b", 2.0), (2, None, 1.0), (None, "z", 1.0), (None, "y", 1.0)]
    df = frame(rows, "k int, s string, v double")
    assert q.dedupe_rows(df).count() == 5
    for parts in (1, 3):
        got = q.dedupe_by_key(df.repartition(parts), ["k"], ["s"])
        assert {tuple(r) for r in got.collect()} == {(1, "a", None), (2, None, 1.0), (None, "y", 1.0)}
    assert got.columns == df.columns


def test_outliers_flagged_and_capped(frame):
    values = [10.0] * 10 + [11.0] * 10 + [500.0, None, float("nan")]
    df = frame([(i, v, 3.0) for i, v in enumerate(values)], "i int, v double, flat double")
    got = q.flag_and_cap(df, ["v", "flat", "absent"], k=3.0).orderBy("i").collect()
    clean = values[:21]
    high = statistics.mean(clean) + 3 * statistics.stdev(clean)
    assert [r.v_is_outlier for r in got] == [False] * 20 + [True, None, None]
    assert got[20].v == pytest.approx(high)
    assert [r.v for r in got[:20]] == values[:20] and got[22].v is None
    assert {r.flat_is_outlier for r in got} == {False} and {r.flat for r in got} == {3.0}


def test_outliers_of_too_little_data(frame):
    one = q.flag_and_cap(frame([(5.0,)], "v double"), ["v"]).first()
    assert (one.v, one.v_is_outlier) == (5.0, False)
    assert q.flag_and_cap(frame([], "v double"), ["v"]).count() == 0
    assert q.flag_and_cap(frame([(1,)], "x int"), ["v"]).columns == ["x"]


def test_outlier_bounds_hold(frame):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(300)] + [40.0, -40.0]
    got = q.flag_and_cap(frame([(v,) for v in values], "v double"), ["v"], 2.0).collect()
    mean, sd = statistics.mean(values), statistics.stdev(values)
    for r in got:
        assert mean - 2 * sd - 1e-9 <= r.v <= mean + 2 * sd + 1e-9


def test_grain_and_foreign_keys(frame):
    df = frame([(1, 1), (1, 1), (1, None), (None, None), (None, None)], "a int, b int")
    assert tuple(q.grain_check(df, ["a", "b"]).first()) == (5, 3, 2)
    assert tuple(q.null_fk_report(df, ["a", "b"]).first()) == (5, 3, 60.0)
    empty = df.limit(0)
    assert tuple(q.grain_check(empty, ["a"]).first()) == (0, 0, 0)
    assert tuple(q.null_fk_report(empty, ["a"]).first()) == (0, 0, 0.0)


@pytest.mark.parametrize("kept, delta, change", [(2, -1, "removed"), (3, 0, "unchanged")])
def test_row_delta(spark, kept, delta, change):
    row = q.row_delta(spark.range(3), spark.range(kept)).first()
    assert (row.rows_before, row.rows_after, row.delta, row.change) == (3, kept, delta, change)


def test_validation_report(frame):
    df = frame([("2024-01-01", 1), ("2024-01-01", 1), ("soon", None), (None, 2)], "d string, n int")
    checks = dict(expected_columns=["d", "x"], expected_types={"n": LongType(), "d": StringType(), "x": LongType()})
    row = q.validation_report(df, "s", date_column="d", **checks).first()
    assert (row.row_count, row.duplicate_row_count, row.invalid_date_count) == (4, 1, 1)
    assert (row.nulls_d, row.nulls_n, row.is_empty, row.passed) == (1, 1, False, False)
    assert (row.missing_columns, row.unexpected_columns) == (["x"], ["n"])
    assert row.type_mismatches == ["n: expected=LongType() actual=IntegerType()"]
    cheap = q.validation_report(df, "s", count_duplicates=False).first()
    assert (cheap.row_count, cheap.duplicate_row_count, cheap.invalid_date_count) == (4, None, None)
    assert cheap.passed and cheap.issues == []
    nothing = q.validation_report(df.limit(0), "s").first()
    assert (nothing.row_count, nothing.is_empty, nothing.nulls_d) == (0, True, 0)


def test_profile(frame):
    got = {r.column_name: r for r in q.profile(frame([(1, "b"), (3, "a"), (None, None)], "n int, s string")).collect()}
    assert (got["n"]["count"], got["n"].nulls, got["n"].mean, got["n"].min, got["n"].max) == (2, 1, 2.0, "1", "3")
    assert got["n"].quartiles == [1.0, 1.0, 3.0]
    assert (got["s"].mean, got["s"].min, got["s"].quartiles) == (None, "a", None)


#: Built-in for small groups, one bracket, and brackets that are narrowed again and again.
WAYS = [{}, {"small": 0}, {"small": 0, "most_inside": 4}]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed,accuracy", [(1, 10), (2, 100), (3, 10000)])
def test_exact_medians(frame, seed, accuracy, way):
    rng = random.Random(seed)
    rows = []
    for key, size in (("hot", 701), ("even", 40), ("two", 2), ("one", 1), ("none", 3), (None, 9)):
        for _ in range(size):
            x = rng.choice([rng.gauss(0, 5), rng.randrange(3), None]) if key != "none" else None
            rows.append((key, x if x is None else float(x), float(rng.randrange(2))))
    df = frame(rows, "k string, x double, y double").repartition(5)

    def median(key, i):
        kept = [r[i] for r in rows if r[i] is not None and (key == "*" or r[0] == key)]
        return statistics.median(kept) if kept else None

    got = {r.k: (r.x, r.y) for r in exact_medians(df, ["x", "y"], ["k"], accuracy, **way).collect()}
    assert got == {k: (median(k, 1), median(k, 2)) for k in ("hot", "even", "two", "one", "none", None)}
    overall = exact_medians(df, ["x", "y"], accuracy=accuracy, **way).collect()
    assert [tuple(r) for r in overall] == [(median("*", 1), median("*", 2))]


@pytest.mark.parametrize("way", WAYS)
def test_exact_percentiles(frame, way):
    rng = random.Random(9)
    values = [float(rng.randrange(200)) for _ in range(503)]
    df = frame([(v,) for v in values], "v double").repartition(4)
    row = exact_percentiles(df, ["v"], [0.0, 0.1, 0.25, 0.999, 1.0], accuracy=50, **way).first()
    ordered = sorted(values)
    ranks = {"v_p0": 1, "v_p10": 51, "v_p25": 126, "v_p99.9": 503, "v_p100": 503}
    assert row.asDict() == {name: ordered[rank - 1] for name, rank in ranks.items()}


def test_medians_of_nothing(frame):
    df = frame([], "k string, v double")
    assert exact_medians(df, ["v"], ["k"]).count() == 0
    assert exact_medians(df, ["v"]).first().v is None


def test_no_bracket_holds_a_share_of_a_group(spark):
    """Brackets shrink by passes until they hold few values, also where one value is most of a group."""
    tied = F.when(F.col("id") % 10 < 6, 0.5).otherwise(F.hash("id") / 2**32)
    df = spark.range(0, 60_000, 1, 4).select((F.col("id") % 2).alias("k"), tied.alias("v"), F.hash("id", F.lit(1)).cast("double").alias("w"))
    rows = [(r.k, r.v, r.w) for r in df.collect()]
    got = {r.k: r for r in exact_percentiles(df, ["v", "w"], [0.25, 0.5], ["k"], small=0, most_inside=20).collect()}
    for k in (0, 1):
        for i, c in ((1, "v"), (2, "w")):
            ordered = sorted(r[i] for r in rows if r[0] == k)
            assert [got[k][f"{c}_p{p}"] for p in (25, 50)] == [ordered[-(-len(ordered) * p // 100) - 1] for p in (25, 50)]
    values = df.select("k", F.col("v").alias("_v_v"))
    begin = values.groupBy("k").agg(
        F.array(F.struct(F.count("_v_v").alias("n"), F.min("_v_v").alias("low"), F.max("_v_v").alias("high"), F.lit(1e9).alias("held"))).alias("_b")
    )
    held = []
    for _ in range(3):
        begin = quantiles._narrowed(values, begin, [("v", 0.25, "v")], ["k"], 10000, False).cache()
        b = begin.where("k = 0").select(F.get("_b", 0).alias("b")).first().b
        held.append(df.where((F.col("k") == 0) & (F.col("v") > b.low) & (F.col("v") < b.high)).select("v").distinct().count())
    assert held[0] <= 0.01 * 30_000 and held[-1] <= 8


def test_reports_stay_lazy(spark):
    """Building a report must not run a job."""
    tracker = spark.sparkContext.statusTracker()
    group = "lazy-check"
    spark.sparkContext.setJobGroup(group, group)
    df = spark.range(10).withColumn("v", F.col("id") * 1.0)
    q.flag_and_cap(df, ["v"])
    q.validation_report(df, "s")
    q.profile(df, quartiles=False)
    assert list(tracker.getJobIdsForGroup(group)) == []


def test_hot_key_join_feeds_its_own_shuffle(spark, frame):
    """Without it adaptive execution could not split a hot key of the bracket join."""
    df = frame([("a", 1.0)], "k string, v double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = exact_medians(df, ["v"], ["k"], small=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above_join = plan[: plan.index("SortMergeJoin")]
    assert "hashpartitioning(k" in above_join and "_v" in above_join[above_join.rindex("Exchange") :]


def test_medians_keep_null_keys_and_empty_groups(frame):
    from siltbed.operators.quantiles import exact_medians

    df = frame([("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0)], "k string, v double")
    got = {r.k: r.v for r in exact_medians(df, ["v"], ["k"]).collect()}
    assert got == {"a": 2.0, "b": None, None: 5.0}
