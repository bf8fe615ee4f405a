"""Jobs that need each other: order, time shared, failures and runs taken up again."""

from __future__ import annotations

import threading
from graphlib import CycleError

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltbed.plans.jobs import Job, TablesOnDemand, finished_jobs, run_jobs
from siltbed.sources.writers import write_table


@pytest.fixture
def write(spark, tmp_path):
    """``write(name, n)`` gives a function that writes n rows, and notes that it was called."""
    calls = []

    def of(name, rows=3, source=None):
        def run():
            calls.append(name)
            df = spark.range(rows) if source is None else spark.read.parquet(f"{tmp_path}/{source}")
            return write_table(df, f"{tmp_path}/{name}")

        return run

    of.calls = calls
    return of


def test_tables_are_written_after_those_they_read(spark, write):
    jobs = {"c": Job(write("c", source="b"), ("b",)), "b": Job(write("b", source="a"), ("a",)), "a": Job(write("a"))}
    report = run_jobs(spark, jobs)
    assert write.calls == ["a", "b", "c"]
    assert {n: r.rows for n, r in report.written.items()} == {"a": 3, "b": 3, "c": 3}
    assert not report.failures and not report.left_out and not report.kept


def test_independent_tables_are_written_at_the_same_time(spark, write):
    # Neither ends before both have begun.
    both = threading.Barrier(2, timeout=60)

    def meeting(name):
        def run():
            both.wait()
            return write(name)()

        return run

    report = run_jobs(spark, {n: Job(meeting(n)) for n in "ab"}, width=2)
    assert set(report.written) == {"a", "b"} and not report.failures


def test_a_failure_stops_only_what_needs_it(spark, write, tmp_path):
    def broken():
        fail = F.raise_error(F.lit("lost task")).cast("long")
        return write_table(spark.range(3).select(F.when(F.col("id") == 2, fail).otherwise(F.col("id")).alias("id")), f"{tmp_path}/bad")

    jobs = {
        "bad": Job(broken),
        "after": Job(write("after"), ("bad",)),
        "later": Job(write("later"), ("after", "good")),
        "good": Job(write("good")),
        "beside": Job(write("beside"), ("good",)),
    }
    report = run_jobs(spark, jobs)
    assert set(report.written) == {"good", "beside"}
    assert "lost task" in report.failures["bad"]
    assert report.left_out == {"after": ["bad"], "later": ["after"]}
    assert set(write.calls) == {"good", "beside"}


def test_finished_jobs_are_not_run_again(spark, write, tmp_path):
    record, broken = f"{tmp_path}/run", [True]

    def once_broken():
        if broken.pop():
            raise RuntimeError("executor lost")
        return write("b")()

    jobs = {"a": Job(write("a")), "b": Job(once_broken, ("a",)), "c": Job(write("c", source="b"), ("b",))}
    first = run_jobs(spark, jobs, record)
    assert (set(first.written), first.failures, first.left_out) == ({"a"}, {"b": "executor lost"}, {"c": ["b"]})
    broken.append(False)
    second = run_jobs(spark, jobs, record)
    assert (set(second.kept), set(second.written)) == ({"a"}, {"b", "c"})
    assert second.kept["a"] == first.written["a"]
    third = run_jobs(spark, jobs, record)
    assert set(third.kept) == {"a", "b", "c"} and not third.written
    assert write.calls == ["a", "b", "c"]
    # Another record starts anew.
    broken.append(False)
    assert set(run_jobs(spark, jobs, f"{tmp_path}/other").written) == {"a", "b", "c"}


def test_a_table_whose_source_is_written_anew_is_written_anew(spark, write, tmp_path):
    record = f"{tmp_path}/run"
    run_jobs(spark, {"b": Job(write("b"))}, record)
    assert set(finished_jobs(spark, record)) == {"b"}
    report = run_jobs(spark, {"a": Job(write("a")), "b": Job(write("b"), ("a",))}, record)
    assert set(report.written) == {"a", "b"} and not report.kept


def test_graphs_that_cannot_be_run(spark, write):
    with pytest.raises(ValueError, match="no job writes: \\['x'\\]"):
        run_jobs(spark, {"a": Job(write("a"), ("x",))})
    with pytest.raises(CycleError):
        run_jobs(spark, {"a": Job(write("a"), ("b",)), "b": Job(write("b"), ("a",))})
    assert run_jobs(spark, {}).written == {} and not write.calls


def test_tables_are_read_on_demand(spark, tmp_path):
    asked = []
    tables = TablesOnDemand(lambda name: asked.append(name) or spark.read.parquet(f"{tmp_path}/{name}"))
    write_table(spark.range(2), f"{tmp_path}/a")
    assert tables["a"].count() == tables["a"].count() == 2 and asked == ["a"]
    with pytest.raises(PySparkException):
        tables["missing"]
