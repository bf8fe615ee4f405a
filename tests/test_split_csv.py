"""Multi-line CSV read by ranges against Spark's whole-file reader and Python's csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from siltbed.errors import MissingInputError
from siltbed.sources.readers import read_csv
from siltbed.sources.split_csv import csv_lines, read_split_csv

SCHEMA = "id bigint, note string, size int"


@pytest.fixture
def ranges(spark):
    """Ranges of 512 bytes instead of megabytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _landed(tmp_path, rows, name="a.csv", end="\n"):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end)
    writer.writerow(["id", "note", "size"])
    writer.writerows(rows)
    (tmp_path / name).write_bytes(text.getvalue().encode())
    return str(tmp_path)


def _random_rows(seed, count):
    draw = random.Random(seed)
    pieces = ["\n", '"', ",", "ä", "text", " ", '""', "\n\n", "5\" disk", "\r\n"]
    return [(i, "x" + "".join(draw.choices(pieces, k=draw.randrange(12))), i % 50) for i in range(count)]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equals_the_rows_written(spark, tmp_path, ranges, seed, end):
    rows = _random_rows(seed, 400)
    more = _random_rows(seed + 10, 50)
    path = _landed(tmp_path, rows, end=end)
    _landed(tmp_path, more, "b.csv", end)
    lines = csv_lines(spark, path)
    assert lines.select("file", "range_start").distinct().count() > 10
    read = read_split_csv(spark, path, SCHEMA)
    got = sorted(tuple(r) for r in read.rows.collect())
    assert got == sorted(rows + more)
    if end == "\n":
        assert got == sorted(tuple(r) for r in read_csv(spark, path, SCHEMA).collect())
    assert read.quarantine.count() == 0


def test_a_record_over_many_ranges(spark, tmp_path, ranges):
    long = "first\n" + "\n".join(f"line {i} of, the \"note\"" for i in range(300)) + "\nlast"
    path = _landed(tmp_path, [(1, "a", 1), (2, long, 2), (3, "b\nc", 3)])
    read = read_split_csv(spark, path, SCHEMA)
    assert {tuple(r) for r in read.rows.collect()} == {(1, "a", 1), (2, long, 2), (3, "b\nc", 3)}
    bounded = read_split_csv(spark, path, SCHEMA, most_lines=100)
    assert {r.id for r in bounded.rows.collect()} == {1, 3}
    left = bounded.quarantine.collect()
    assert {r.reason for r in left} == {"too_long"} and len(left) == 302


def test_what_cannot_be_parsed_is_quarantined(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text(
        'id,note,size\n1,good,1\n2,"two\nlines",two\n3,few\n4,5" disk,4\n\n5,a,b,c\n6,"open,6\n7,lost,7\n'
    )
    _landed(tmp_path, [(9, "other file", 9)], "b.csv")
    read = read_split_csv(spark, str(tmp_path), SCHEMA)
    assert {tuple(r) for r in read.rows.collect()} == {(1, "good", 1), (4, '5" disk', 4), (9, "other file", 9)}
    left = {(r.reason, r.raw) for r in read.quarantine.collect()}
    assert left == {
        ("malformed", '2,"two\nlines",two'),
        ("malformed", "3,few"),
        ("malformed", "5,a,b,c"),
        ("unclosed", '6,"open,6'),
        ("unclosed", "7,lost,7"),
    }


def test_nulls_empty_texts_and_empty_files(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text('id,note,size\n,,\n1,"",\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("id,note,size\n")
    read = read_split_csv(spark, str(tmp_path), SCHEMA)
    expected = read_csv(spark, str(tmp_path), SCHEMA).collect()
    assert {tuple(r) for r in read.rows.collect()} == {tuple(r) for r in expected}
    assert read.rows.count() == 2
    with pytest.raises(MissingInputError):
        read_split_csv(spark, str(tmp_path / "none"), SCHEMA)


def test_other_delimiters_and_no_header(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text('1|"a|b\nc"|1\n2|d,e|2\n')
    read = read_split_csv(spark, str(tmp_path), SCHEMA, delimiter="|", header=False)
    assert {tuple(r) for r in read.rows.collect()} == {(1, "a|b\nc", 1), (2, "d,e", 2)}


def test_very_long_lines_need_no_stack(spark, tmp_path):
    long = '"",""' * 400_000 + "x" * 1_000_000
    path = _landed(tmp_path, [(1, long, 1), (2, long + "\n" + long, 2)])
    read = read_split_csv(spark, path, SCHEMA)
    got = read.rows.select("id", F.length("note").alias("n")).collect()
    assert {tuple(r) for r in got} == {(1, len(long)), (2, 2 * len(long) + 1)}
