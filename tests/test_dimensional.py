"""Dimensions, lookups and joins."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.functions import surrogate_key
from siltbed.operators import dimensional as d
from siltbed.operators.rollup import absent_metrics, compound_growth, rollup


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_union_members_and_keys(frame):
    a = frame([("x",), (None,), ("y",)], "name string")
    b = frame([("y", 1), ("z", 2)], "label string, n int")
    members = d.union_members([(a, "name"), (b, "label")], "m")
    assert rows(members) == [("x",), ("y",), ("z",)]
    dim = d.with_key(members, "key", ["m"], {"upper": F.upper("m")})
    assert dim.columns == ["key", "m", "upper"]
    again = d.with_key(members.repartition(3), "key", ["m"], {"upper": F.upper("m")})
    assert rows(dim) == rows(again)
    with pytest.raises(ValueError):
        d.union_all([])


def test_distinct_dimension_keeps_missing_attributes(frame):
    df = frame([("p", "c", None), ("p", "c", None), ("p", "c", "u"), (None, "c", "u")], "a string, b string, c string")
    dim = d.distinct_dimension(df, "key", {"a": "product", "b": "category", "c": "unit"})
    assert dim.count() == 2 and dim.select("key").distinct().count() == 2


def test_date_dimension(frame):
    years = frame([(2024,), (None,), (7,)], "y bigint")
    dates = frame([(dt.date(2024, 1, 1),), (dt.date(2020, 12, 31),)], "d date")
    texts = frame([("2024-12-30 10:00:00",), ("soon",)], "t string")
    got = d.date_dimension([(years, "y")], [(dates, "d"), (texts, "t")]).drop("date_key")
    assert rows(got) == [
        (dt.date(2020, 12, 31), 31, 12, 4, 2020, 53),
        (dt.date(2024, 1, 1), 1, 1, 1, 2024, 1),
        (dt.date(2024, 12, 30), 30, 12, 4, 2024, 1),
    ]


def test_lookups_never_fan_out(frame):
    fact = frame([("nvda", 1), ("amd", 2), (None, 3)], "t string, n int")
    dim = frame([(9, "nvda"), (4, "nvda"), (5, None)], "key bigint, t string")
    got = d.lookup_key(fact, dim, {"t": "t"}, "key", unique=False)
    assert rows(got) == [("amd", 2, None), ("nvda", 1, 4), (None, 3, None)]
    safe = d.lookup_key(fact, dim, {"t": "t"}, "key", unique=False, null_safe=True)
    assert rows(safe) == [("amd", 2, None), ("nvda", 1, 4), (None, 3, 5)]


def test_enrich_on_computed_keys(frame):
    base = frame([(" A ", 1, 5), ("b", 1, None), (None, 2, 5)], "name string, year int, node int")
    other = frame([("a", 1, 5.0, 0.5), ("b", 1, None, 0.7)], "company string, year int, size double, x double")
    got = d.enrich(
        base,
        other,
        [
            (F.lower(F.trim(F.col("name"))), F.col("company")),
            (F.col("year"), F.col("year")),
            (F.col("node").cast("double"), F.col("size")),
        ],
        ["x"],
    )
    assert got.columns == ["name", "year", "node", "x"]
    assert rows(got) == [(" A ", 1, 5, 0.5), ("b", 1, None, None), (None, 2, 5, None)]


def test_enrich_keeps_the_grain_of_its_base(frame):
    base = frame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n int")
    other = frame([("A", 1.0, 9.0), ("a ", 2.0, None), ("a", None, 5.0), (None, 7.0, 7.0)], "k2 string, x double, y double")
    on = [(F.col("k"), F.lower(F.trim(F.col("k2"))))]
    got = d.enrich(base, other, on, ["x", "y"], unique=False)
    assert rows(got) == [("a", 1, 2.0, None), ("a", 2, 2.0, None), ("b", 3, None, None), (None, 4, None, None)]


def test_outer_enrich_equals_full_outer_join(frame):
    left = frame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "year int, c string")
    right = frame([(1, 10.0), (3, 30.0), (3, 31.0), (None, 0.0)], "year int, m double")
    got = d.outer_enrich(left, right, ["year"])
    assert rows(got) == rows(left.join(right, "year", "outer"))


def test_conform(frame):
    members = frame([("nvidia",), ("NVDA",), ("amd",)], "name string")
    code = F.when(F.col("name").startswith("n"), "NVDA").otherwise(F.col("name"))
    dim = d.conform(members, "name", code, "key", "ticker")
    assert {(r.name, r.ticker) for r in dim.collect()} == {("NVDA", "NVDA"), ("amd", "amd")}
    assert dim.filter(dim.key == surrogate_key(F.col("ticker"))).count() == 2


def test_rollup_with_absent_column(frame):
    df = frame([("a", 1.0, 2), ("a", 3.0, 5)], "k string, x double, n int")
    metrics = {"x": "avg", "n": "max", "gone": "sum"}
    assert rows(rollup(df, ["k"], metrics)) == [("a", 2.0, 5, None)]
    assert absent_metrics(df, metrics) == ["gone"]


def test_compound_growth(frame):
    df = frame([(2026, 100.0), (2028, 121.0), (2027, 50.0)], "y int, v double")
    got = {r.y: r.cagr for r in compound_growth(df, "y", "v").collect()}
    assert got == {2026: 0.0, 2027: pytest.approx(-0.5), 2028: pytest.approx(0.1)}
    zero = compound_growth(frame([(1, 0.0), (2, 5.0)], "y int, v double"), "y", "v")
    assert {r.cagr for r in zero.collect()} == {0.0}
