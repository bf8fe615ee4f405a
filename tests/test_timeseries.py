"""Ordered series against plain Python, whole keys and slices alike."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltbed.operators.intervals import explode_daily, validity_intervals
from siltbed.operators.timeseries import (
    daily_bars,
    forward_fill,
    moving_averages,
    percent_change,
    previous_values,
    range_sliced,
    running_product,
    technical_features,
)

START = dt.date(2024, 1, 1)


def series(seed: int, rows: int, gap: float):
    """Rows (key, n, value): one hot key, one small, one of a single row, NULL runs."""
    rng = random.Random(seed)
    out = []
    for key, size in (("hot", rows), ("small", 7), ("one", 1), (None, 5)):
        n = 0
        for _ in range(size):
            n += rng.choice([1, 1, 2, 9])
            out.append((key, n, None if rng.random() < gap else round(rng.uniform(0.5, 9), 3)))
    rng.shuffle(out)
    return out


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(r[0], []).append(r)
    return groups


# Width of the slices of n: none, short, long, one for all.
WIDTHS = [None, 5, 40, 10**6]


def slices(width):
    return None if width is None else F.floor(F.col("n") / width)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed, gap", [(1, 0.3), (2, 0.85)])
def test_forward_fill(frame, width, seed, gap):
    rows = series(seed, 60, gap)
    want = set()
    for key, group in by_key(rows).items():
        last = None
        for _, n, v in group:
            last = v if v is not None else last
            want.add((key, n, last))
    df = frame(rows, "k string, n int, v double")
    got = forward_fill(df, ["k"], ["n"], ["v"], slices(width))
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("width", WIDTHS)
def test_backward_fill_and_previous(frame, width):
    rows = series(21, 60, 0.6)
    filled, previous = set(), set()
    for key, group in by_key(rows).items():
        nxt = None
        for _, n, v in reversed(group):
            nxt = v if v is not None else nxt
            filled.add((key, n, nxt))
        for before, (_, n, v) in zip([(None, None, None), *group], group):
            previous.add((key, n, v, before[2]))
    df = frame(rows, "k string, n int, v double")
    got = forward_fill(df, ["k"], ["n"], ["v"], slices(width), descending=True)
    assert {tuple(r) for r in got.collect()} == filled
    got = previous_values(df, ["k"], ["n"], {"p": "v"}, slices(width))
    assert {tuple(r) for r in got.collect()} == previous


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed, gap", [(3, 0.0), (4, 0.5)])
def test_moving_averages(frame, width, seed, gap):
    rows = series(seed, 60, gap)
    want = {}
    for key, group in by_key(rows).items():
        for i, (_, n, _) in enumerate(group):
            for span in (1, 5, 20):
                kept = [v for _, _, v in group[max(0, i - span + 1) : i + 1] if v is not None]
                want[key, n, span] = pytest.approx(sum(kept) / len(kept)) if kept else None
    df = frame(rows, "k string, n int, v double")
    spans = {"a1": 1, "a5": 5, "a20": 20}
    got = moving_averages(df, ["k"], ["n"], "v", spans, slices(width)).collect()
    assert len(got) == len(rows)
    for r in got:
        for name, span in spans.items():
            assert r[name] == want[r.k, r.n, span]


@pytest.mark.parametrize("width", WIDTHS)
def test_running_product(frame, width):
    rows = [(k, n, None if v is None else (v - 4) / 50) for k, n, v in series(5, 60, 0.3)]
    want = {}
    for key, group in by_key(rows).items():
        product = None
        for _, n, r in group:
            if r is not None:
                product = (1 if product is None else product) * (1 + r)
            want[key, n] = None if product is None else pytest.approx(min(18, max(5, 10 * product)))
    df = frame(rows, "k string, n int, r double")
    got = running_product(df, ["k"], ["n"], "r", F.lit(10.0), "p", slice_by=slices(width)).collect()
    assert {(r.k, r.n): r.p for r in got} == want


def test_sliced_features_equal_whole_keys(frame):
    rng = random.Random(7)
    rows = []
    for key, size in (("hot", 150), ("b", 12)):
        for i in range(size):
            close, volume = rng.choice([0.0, None, 5.0, 7.5]), rng.choice([0, None, 10])
            rows.append((key, START + dt.timedelta(days=i), rng.choice([0.0, 4.0]), 9.0, 1.0, close, volume))
    schema = "k string, d date, open double, high double, low double, close double, volume bigint"
    df = frame(rows, schema)
    whole = technical_features(df, ["k"], ["d"])
    sliced = technical_features(df, ["k"], ["d"], slice_by=F.trunc("d", "week"))
    assert whole.columns == sliced.columns
    for a, b in zip(whole.orderBy("k", "d").collect(), sliced.orderBy("k", "d").collect()):
        assert tuple(a) == pytest.approx(tuple(b), nan_ok=True) or list(a) == list(b)


def test_range_slices_split_a_hot_key(spark, frame):
    rows = series(12, 400, 0.4)
    df = frame(rows, "k string, n int, v double").repartition(3)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = range_sliced(df, ["k"], ["n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    sizes = {r.range_slice: r["count"] for r in cut.groupBy("range_slice").count().collect()}
    assert len(sizes) > 2 and max(sizes.values()) < 300
    got = forward_fill(cut, ["k"], ["n"], ["v"], F.col("range_slice")).drop("range_slice")
    want = forward_fill(df, ["k"], ["n"], ["v"])
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    spans = {"a": 20}
    got = moving_averages(cut, ["k"], ["n"], "v", spans, F.col("range_slice")).drop("range_slice")
    want = moving_averages(df, ["k"], ["n"], "v", spans)
    for a, b in zip(got.orderBy("k", "n").collect(), want.orderBy("k", "n").collect()):
        assert tuple(a)[:3] == tuple(b)[:3] and (a.a == b.a or a.a == pytest.approx(b.a))


def test_technical_features_rules(frame):
    rows = [
        ("a", 1, 2.0, 4.0, 1.0, None, 0),
        ("a", 2, 0.0, 4.0, 1.0, 3.0, 7),
        ("a", 3, 2.0, 4.0, 1.0, 0.0, None),
    ]
    df = frame(rows, "k string, d int, open double, high double, low double, close double, volume int")
    got = technical_features(df, ["k"], ["d"], {"ma_2": 2}).orderBy("d").collect()
    assert [r.close for r in got] == [None, 3.0, 3.0]
    assert [r.volume for r in got] == [None, 7, 7]
    assert [r.daily_return for r in got] == [None, None, 0.5]
    assert [r.volatility_range for r in got] == [None, 1.0, 1.0]
    assert [r.ma_2 for r in got] == [None, 3.0, 3.0]


def test_daily_bars_break_ties(frame):
    t = dt.datetime(2024, 1, 1, 9)
    rows = [("a", t, 2, 5.0), ("a", t, 1, 7.0), ("a", t, 3, 6.0)]
    df = frame(rows, "k string, ts timestamp, id int, v double")
    bar = daily_bars(df, "k", "ts", "v", ["id"]).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (7.0, 7.0, 5.0, 6.0, 3)


def test_percent_change(frame):
    rows = [("a", 1, 10.0), ("a", 2, None), ("a", 3, 15.0), ("a", 4, 0.0), ("a", 5, 3.0)]
    got = percent_change(frame(rows, "k string, y int, v double"), ["k"], ["y"], "v", "c").orderBy("y")
    assert [r.c for r in got.collect()] == [0.0, 0.0, 0.5, -1.0, 0.0]


def test_intervals_cover_without_overlap(frame):
    rng = random.Random(11)
    rows = [
        (rng.choice("ab"), "c", START + dt.timedelta(days=rng.randrange(60)), rng.choice([None, 1.0, 2.0, 3.0]), "u")
        for _ in range(80)
    ]
    df = frame(rows, "p string, q string, d date, price double, unit string")
    intervals = validity_intervals(df, ["p", "q"], "d", "price")
    last_day = max(r[2] for r in rows)
    groups = {}
    for r in intervals.orderBy("p", "d").collect():
        groups.setdefault(r.p, []).append(r)
    total = 0
    for key, group in groups.items():
        assert len({r.d for r in group}) == len(group)
        for a, b in zip(group, group[1:]):
            assert a.expiration_date + dt.timedelta(days=1) == b.effective_date
        assert group[-1].expiration_date is None
        best = {d: max((x[3] for x in rows if x[0] == key and x[2] == d and x[3] is not None), default=None) for d in {r.d for r in group}}
        assert {r.d: r.price for r in group} == best
        total += (last_day - group[0].d).days + 1
    daily = explode_daily(intervals)
    assert daily.count() == total
    assert daily.groupBy("p", "date").count().filter("count > 1").count() == 0


def test_single_open_observation(frame):
    df = frame([("a", START, 1.0)], "k string, d date, price double")
    got = explode_daily(validity_intervals(df, ["k"], "d", "price")).collect()
    assert [(r.date, r.expiration_date) for r in got] == [(START, None)]
