"""Column helpers on hand-written values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed import functions as fn
from siltbed.errors import SchemaConflictError
from siltbed.operators import projection as p
from siltbed.plans import fixed_values as fixed


def evaluate(frame, values, expression, kind="string"):
    rows = frame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [("Adj Close", "adj_close"), ("  A--b (c)! ", "a_b_c"), ("__X__Y__", "x_y"), ("été 1", "été_1")],
)
def test_snake_case(raw, expected):
    assert fn.snake_case(raw) == expected


def test_text_normalisation(frame):
    assert evaluate(frame, ["  A\t b \n C ", "", None], fn.normalise_text) == ["a b c", "", None]


def test_parse_price(frame):
    got = evaluate(frame, ["US$ 1,234.50", "", "n/a", "-3.2 USD", "1.2.3", "-", None], fn.parse_price)
    assert got == [1234.5, None, None, pytest.approx(-3.2), None, None, None]


def test_canonical_unit(frame):
    values = ["gb", " GBIT ", "gib", "Gigabyte", "MB", "per unit", "/unit", "US$", "Wafer ", " ", None]
    got = evaluate(frame, values, lambda c: fn.canonical_unit(c, fixed.UNIT_VARIANTS))
    assert got == ["Gb", "Gb", "GiB", "GiB", "Mb", "unit", "unit", "USD", "Wafer", None, None]


def test_unit_suffix(frame):
    got = evaluate(frame, ["1731nm", "7 NM", "x", None], lambda c: fn.strip_unit_suffix(c, "nm"))
    assert got == ["1731", "7", "x", None]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://h.example/price/dram/dram_spot", "dram_spot"),
        ("https://h.example/price/", "price"),
        ("https://h.example", "general"),
        ("https://h.example/?a=/b", "general"),
        ("https://h.example/a b/[c]#top", "[c]"),
        ("/relative/path?x", "path"),
        ("", "general"),
    ],
)
def test_url_category(frame, url, expected):
    assert evaluate(frame, [url], fn.url_category) == [expected]


def test_dates(frame):
    d = dt.date(2024, 3, 5)
    values = ["2024-03-05", "2024-03-05 00:00:00-05:00", "soon", "", None]
    assert evaluate(frame, values, fn.safe_date) == [d, d, None, None, None]
    assert evaluate(frame, ["2024", "2024-03-05", "abcd"], fn.year_or_date) == [dt.date(2024, 1, 1), d, None]
    assert evaluate(frame, [2024, None], fn.year_or_date, "bigint") == [dt.date(2024, 1, 1), None]


def test_numeric_helpers(frame):
    values = [0.0, 4.0, None, float("nan")]
    assert evaluate(frame, values[:3], fn.zero_to_null, "double") == [None, 4.0, None]
    assert evaluate(frame, values, fn.nan_to_null, "double") == [0.0, 4.0, None, None]
    assert evaluate(frame, values[:3], lambda c: fn.safe_ratio(F.lit(2.0), c), "double") == [None, 0.5, None]
    assert evaluate(frame, [-9.0, 0.1, 9.0, None], lambda c: fn.clip(c, -0.5, 1.5), "double") == [-0.5, 0.1, 1.5, None]
    assert evaluate(frame, ["1.5", "x", "NaN", None], fn.safe_double) == [1.5, None, None, None]


def test_company_rules_follow_their_order(frame):
    names = ["nvidia corp", "Advanced Micro Devices", "Micron", "Intel", "amd", "taiwan semi", None]
    got = evaluate(frame, names, lambda c: fn.first_match(c, fixed.COMPANY_TICKER_RULES))
    assert got == ["NVDA", "AMD", "MU", "INTC", "amd", "TSM", None]


def test_region_lookup(frame):
    got = evaluate(frame, [" Japan ", "UAE", "atlantis", None], lambda c: fn.lookup_map(c, fixed.COUNTRY_REGIONS))
    assert got == ["east asia", "middle east", None, None]
    assert len(fixed.COUNTRY_REGIONS) == 40


def test_surrogate_keys_separate_fields_and_nulls(frame):
    rows = frame(
        [("a", "bc"), ("ab", "c"), ("a", None), ("a", ""), ("a", "\\N"), (None, "a")], "x string, y string"
    )
    keys = [r[0] for r in rows.select(fn.surrogate_key(F.col("x"), F.col("y"))).collect()]
    # Only the literal marker text coincides with NULL.
    assert len(set(keys)) == 5 and keys[2] == keys[4]
    assert all(0 <= k < 2**60 for k in keys)
    wide = rows.select(fn.surrogate_key(F.col("x"), wide=True)).first()[0]
    assert len(wide) == 32


def test_projection_helpers(frame):
    df = frame([(" A ", "3.7", "12", 3.7, "q")], "`Na me` string, t string, n string, d double, extra string")
    named = p.standardise_names(df)
    assert named.columns == ["na_me", "t", "n", "d", "extra"]
    schema = {"t": "long", "n": "long", "d": "long", "absent": "double", "extra": "date"}
    row = p.safe_cast(named, schema).first()
    assert (row.t, row.n, row.d, row.extra) == (None, 12, 3, "q")
    assert p.schema_gaps(named, schema) == {
        "missing": ["absent"],
        "undeclared": ["na_me"],
        "unknown_type": ["extra"],
    }
    assert p.normalise_strings(named).first().na_me == "a"
    assert p.with_missing(named, ["z", "t"]).columns[-1] == "z"
    assert p.select_once(named, ["t", "n", "t"]).columns == ["t", "n"]
    with pytest.raises(SchemaConflictError, match="a_b"):
        p.standardise_names(frame([(1, 2)], "`A b` int, `a-B` int"))
