"""Dense codes that later runs keep."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltbed.operators.key_tables import append_members, read_members, with_member_codes


def codes(spark, path):
    return {r.member: (r.code, r.batch) for r in read_members(spark, path).collect()}


def test_later_runs_keep_codes_and_number_only_what_is_new(spark, frame, tmp_path):
    path = str(tmp_path / "keys")
    assert append_members(frame([("c",), ("a",), (None,), ("a",)], "name string"), "name", path).rows == 2
    assert codes(spark, path) == {"a": (0, 1), "c": (1, 1)}
    assert append_members(frame([("b",), ("c",), ("d",)], "name string"), "name", path).rows == 2
    known = {"a": (0, 1), "c": (1, 1), "b": (2, 2), "d": (3, 2)}
    assert codes(spark, path) == known
    assert append_members(frame([("a",), (None,)], "name string"), "name", path).rows == 0
    assert codes(spark, path) == known
    append_members(frame([("0",)], "name string"), "name", path)
    assert codes(spark, path)["0"][0] == 4


def test_an_empty_first_run(spark, frame, tmp_path):
    path = str(tmp_path / "keys")
    assert append_members(frame([], "name string"), "name", path).rows == 0
    assert codes(spark, path) == {}
    append_members(frame([("x",)], "name string"), "name", path)
    assert {m: c for m, (c, _) in codes(spark, path).items()} == {"x": 0}


def test_a_run_that_fails_leaves_the_codes(spark, frame, tmp_path):
    path = str(tmp_path / "keys")
    append_members(frame([("a",)], "name string"), "name", path)
    broken = F.when(F.col("id") == 9, F.raise_error(F.lit("lost task")).cast("string")).otherwise(F.col("id").cast("string"))
    with pytest.raises(PySparkException, match="lost task"):
        append_members(spark.range(10).select(broken.alias("name")), "name", path)
    assert codes(spark, path) == {"a": (0, 1)}


def test_many_members_have_codes_without_gaps(spark, tmp_path):
    path = str(tmp_path / "keys")
    append_members(spark.range(0, 50_000, 2), "id", path)
    append_members(spark.range(0, 60_000), "id", path)
    got = read_members(spark, path)
    assert got.agg(F.count("*"), F.countDistinct("code"), F.min("code"), F.max("code")).first()[:] == (60_000, 60_000, 0, 59_999)
    assert got.filter("batch = 1 AND code * 2 <> member").count() == 0
    assert got.filter("batch = 2 AND code < 25000").count() == 0


def test_codes_of_rows(spark, frame, tmp_path):
    path = str(tmp_path / "keys")
    rows = frame([("b", 1), ("a", 2), (None, 3), ("new", 4)], "name string, code int")
    append_members(rows.filter("code < 4"), "name", path)
    got = {r.name: r.code for r in with_member_codes(rows, "name", "code", path).collect()}
    assert got == {"a": 0, "b": 1, None: -1, "new": -1}
