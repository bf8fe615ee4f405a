"""Step reports: what they count, and that counts come from the job itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltbed.operators import quality as q
from siltbed.operators.steps import StepLog, count_steps, observed_delta, step_table
from siltbed.plans import silver
from siltbed.sources.readers import read_table


def test_each_step_is_counted(frame):
    df = frame([(1, "5", "x"), (2, "n/a", "x"), (2, "n/a", "x"), (3, None, None), (None, None, None)], "a int, b string, c string")

    def chain(d, log):
        d = log.step(d, "types", lambda x: x.withColumn("b", F.col("b").try_cast("int")))
        d = log.step(d, "empty", q.drop_all_null)
        d = log.step(d, "copies", q.dedupe_rows)
        d = log.step(d, "flags", lambda x: x.withColumn("b_is_odd", F.col("b") % 2 == 1))
        return log.step(d, "more", lambda x: x.union(x))

    steps = count_steps(df, chain)
    assert [(s.name, s.rows_in, s.rows_out, s.dropped, s.added, s.nulled, s.flagged) for s in steps] == [
        ("types", 5, 5, 0, 0, {"b": 2}, 0),
        ("empty", 5, 4, 1, 0, {}, 0),
        ("copies", 4, 3, 1, 0, {}, 0),
        ("flags", 3, 3, 0, 0, {}, 1),
        ("more", 3, 6, 0, 3, {}, 0),
    ]
    table = step_table(df.sparkSession, {"chain": steps, "none": []})
    assert table.count() == 5 and table.where("step = 'types'").first().nulled_by_column == {"b": 2}


def test_prices_report_what_does_not_parse(frame):
    rows = [("2024-01-01", "D", "$ 1", "usd", "c"), ("soon", "D", "2", "usd", "c"), ("2024-01-03", "D", "tba", "usd", "c"), ("2024-01-03", "E", "3", "", "c")]
    raw = frame(rows, "Date string, Product string, Price string, Unit string, Category string")
    steps = {s.name: s for s in count_steps(raw, lambda d, log: silver.clean_prices(d, drop_bad_first=True, log=log))}
    assert list(steps) == ["parse", "bad_prices", "intervals", "days", "empty_rows", "without_price"]
    assert steps["parse"].nulled == {"report_date": 1, "price": 1, "unit": 1}
    assert steps["bad_prices"].dropped == 1 and steps["days"].rows_out == steps["without_price"].rows_out
    plain = silver.clean_prices(raw, drop_bad_first=True)
    assert plain.count() == steps["without_price"].rows_out


def test_a_log_that_counted_twice_is_not_believed(spark, frame, tmp_path, monkeypatch):
    frame([(1, "x"), (1, "x"), (None, None)], "a int, b string").write.parquet(str(tmp_path / "in"))

    def recipe(df, log):
        return log.step(log.step(df, "empty", q.drop_all_null), "copies", q.dedupe_rows)

    want = [("empty", 3, 2), ("copies", 2, 1)]
    result = silver.silver_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), recipe)
    assert [(s.name, s.rows_in, s.rows_out) for s in result.steps] == want and result.delta == -2
    assert read_table(spark, str(tmp_path / "out")).count() == 1
    real, calls = StepLog.rows, []

    def twice(log):
        calls.append(1)
        return tuple(2 * n for n in real(log))

    monkeypatch.setattr(StepLog, "rows", twice)
    again = silver.silver_job(spark, str(tmp_path / "in"), str(tmp_path / "out2"), recipe)
    assert calls and [(s.name, s.rows_in, s.rows_out) for s in again.steps] == want


def test_report_table_of_a_lake(spark, frame, tmp_path):
    frame([(1, "x"), (1, "x")], "a int, b string").write.parquet(str(tmp_path / "in"))
    result = silver.silver_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), lambda d, log: log.step(d, "copies", q.dedupe_rows))
    written = silver.write_step_report(spark, str(tmp_path), {"one": result})
    assert written.rows == 1
    row = read_table(spark, written.path).first()
    assert (row.chain, row.step, row.rows_in, row.rows_out, row.dropped) == ("one", "copies", 2, 1, 1)


@pytest.mark.parametrize("n,change", [(0, "removed"), (1, "unchanged"), (3, "added")])
def test_delta_runs_the_step_once(frame, n, change):
    df = frame([(1,), (2,)], "a int")
    runs = df.sparkSession.sparkContext.accumulator(0)

    def step(d):
        runs.add(1)
        return d.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n)))) if n else d.limit(0)

    assert observed_delta(df, "s", step).first() == (2, 2 * n, 2 * n - 2, change)
    assert runs.value == 1


def test_duplicated_names_of_flags_and_null_groups(frame):
    df = frame([(None, True), (2, False)], "`odd name` int, flag boolean")
    (step,) = count_steps(df, lambda d, log: log.step(d, "none", lambda x: x))
    assert (step.rows_in, step.rows_out, step.flagged, step.nulled) == (2, 2, 0, {})
