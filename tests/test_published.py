"""Published tables: versions, keyed replacement and writes that fail half-way."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltbed.errors import MissingInputError
from siltbed.sources.published import (
    commits,
    publish_keys,
    publish_table,
    read_published,
    unused_folders,
)

SCHEMA = "id bigint, kind string, value double"
ROWS = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, None, 4.0)]


def _failing(df):
    """Rows are written until a task meets the last one."""

    @F.udf("double")
    def fail(i, value):
        if i == 4:
            raise ValueError("lost task")
        return value

    return df.repartition(4, "id").withColumn("value", fail("id", "value"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(MissingInputError):
        read_published(spark, path)
    assert publish_table(frame(ROWS, SCHEMA), path).rows == 4
    publish_table(read_published(spark, path).filter("id > 2").withColumn("more", F.lit(1)), path, ["kind"])
    assert _rows(read_published(spark, path)) == sorted([(3, "b", 3.0, 1), (4, None, 4.0, 1)], key=str)
    assert _rows(read_published(spark, path, 1)) == sorted(ROWS, key=str)
    with pytest.raises(MissingInputError):
        read_published(spark, path, 3)


@pytest.mark.parametrize("publish", [publish_table, lambda df, path: publish_keys(df, path, ["kind"])])
def test_a_failing_write_leaves_the_last_version(spark, frame, tmp_path, publish):
    path = str(tmp_path / "t")
    publish(frame(ROWS, SCHEMA), path)
    with pytest.raises(PySparkException):
        publish(_failing(frame(ROWS, SCHEMA)), path)
    assert _rows(read_published(spark, path)) == sorted(ROWS, key=str)
    assert commits(spark, path).count() == 1
    publish(frame(ROWS[:1], SCHEMA), path)
    assert commits(spark, path).agg(F.max("version")).first()[0] == 2


def test_keys_replace_only_their_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish_keys(frame(ROWS, SCHEMA), path, ["kind"])
    publish_keys(frame([(9, "a", 9.0), (8, None, 8.0), (7, "c", 7.0)], SCHEMA), path, ["kind"])
    expected = [(9, "a", 9.0), (8, None, 8.0), (7, "c", 7.0), (3, "b", 3.0)]
    assert _rows(read_published(spark, path)) == sorted(expected, key=str)
    publish_keys(frame([], SCHEMA), path, ["kind"])
    assert _rows(read_published(spark, path)) == sorted(expected, key=str)
    assert _rows(read_published(spark, path, 1)) == sorted(ROWS, key=str)
    publish_keys(read_published(spark, path).withColumn("value", F.col("value") + 1), path, ["kind"])
    assert _rows(read_published(spark, path)) == sorted([(i, k, v + 1) for i, k, v in expected], key=str)
    assert read_published(spark, path).columns == ["id", "kind", "value"]


def test_keys_and_columns_must_stay(frame, tmp_path):
    path = str(tmp_path / "t")
    publish_keys(frame(ROWS, SCHEMA), path, ["kind"])
    with pytest.raises(ValueError, match="keyed by"):
        publish_keys(frame(ROWS, SCHEMA), path, ["id"])
    with pytest.raises(ValueError, match="columns differ"):
        publish_keys(frame(ROWS, SCHEMA).drop("value"), path, ["kind"])
    with pytest.raises(ValueError, match="at least one"):
        publish_keys(frame(ROWS, SCHEMA), path, [])


def test_an_empty_table_can_be_published(spark, frame, tmp_path):
    for i, publish in enumerate((publish_table, lambda df, path: publish_keys(df, path, ["kind"]))):
        path = str(tmp_path / f"t{i}")
        publish(frame([], SCHEMA), path)
        assert read_published(spark, path).count() == 0


def test_unused_folders(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish_keys(frame(ROWS, SCHEMA), path, ["kind"])
    publish_keys(frame([(9, "a", 9.0)], SCHEMA), path, ["kind"])
    assert unused_folders(spark, path, 1).count() == 0
    publish_keys(frame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)], SCHEMA), path, ["kind"])
    assert unused_folders(spark, path, 1).count() == 2
    assert unused_folders(spark, path, 2).count() == 0
