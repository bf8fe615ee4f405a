"""What each step of a chain did, counted while the chain runs.

A ``StepLog`` observes a table before the first step and behind every one: its rows and the
values present in each column. The counts belong to the job that runs the chain anyway, so
nothing is read twice. Differences between neighbouring points tell how many rows a step
dropped or added, how many values it turned into NULL and how many rows it flagged.

A map stage that runs again after an executor was lost is counted again. ``checked``
therefore compares the ends of the log with what is known of the tables and says whether the
log can be believed; ``silver_job`` counts anew if not.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

SCHEMA = (
    "position int, step string, rows_in long, rows_out long, dropped long, added long, nulled long, flagged long, "
    "nulled_by_column map<string,long>"
)


@dataclass(frozen=True)
class Step:
    """The difference a step made. ``nulled`` counts values by column, for steps that keep all rows."""

    position: int
    name: str
    rows_in: int
    rows_out: int
    nulled: dict[str, int]
    flagged: int

    @property
    def dropped(self) -> int:
        return max(self.rows_in - self.rows_out, 0)

    @property
    def added(self) -> int:
        return max(self.rows_out - self.rows_in, 0)

    def row(self) -> tuple:
        total = sum(self.nulled.values())
        return (self.position, self.name, self.rows_in, self.rows_out, self.dropped, self.added, total, self.flagged, self.nulled)


@dataclass
class _Point:
    name: str
    observation: Observation
    columns: list[str]
    flags: list[str]
    renamed: Mapping[str, str]
    table: DataFrame
    counts: list[Column]
    got: dict[str, int] = field(default_factory=dict)

    def read(self) -> dict[str, int]:
        if not self.got:
            try:
                self.got = self.observation.get
            except Py4JJavaError:
                # A chain that is empty whatever it reads is not run, so nothing was observed.
                self.got = self.table.agg(*self.counts).first().asDict()
        return self.got


class StepLog:
    """Collects the points of one chain; readable once a job has run it."""

    def __init__(self) -> None:
        self._points: list[_Point] = []

    def start(self, df: DataFrame) -> DataFrame:
        """The table before the first step."""
        return self._observed(df, "", {})

    def step(
        self, df: DataFrame, name: str, function: Callable[..., DataFrame], *args, renamed: Mapping[str, str] | None = None
    ) -> DataFrame:
        """``function(df, *args)``, observed. ``renamed`` tells new names of columns by their old ones."""
        if not self._points:
            df = self.start(df)
        return self._observed(function(df, *args), name, renamed or {})

    def _observed(self, df: DataFrame, name: str, renamed: Mapping[str, str]) -> DataFrame:
        flags = [f.name for f in df.schema if isinstance(f.dataType, BooleanType)]
        counts = [
            F.count(F.lit(1)).alias("rows"),
            *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(df.columns)],
            *[F.count_if(F.col(f"`{c}`")).alias(f"f{i}") for i, c in enumerate(flags)],
        ]
        point = _Point(name, Observation(), df.columns, flags, renamed, df, counts)
        self._points.append(point)
        return df.observe(point.observation, *counts)

    def steps(self) -> list[Step]:
        """One entry per step, in order."""
        out = []
        for position, (before, after) in enumerate(zip(self._points, self._points[1:]), 1):
            old, new = before.read(), after.read()
            nulled = {}
            if old["rows"] == new["rows"]:
                place = {before.renamed.get(c, c): i for i, c in enumerate(before.columns)}
                place = {after.renamed.get(c, c): i for c, i in place.items()}
                for i, c in enumerate(after.columns):
                    lost = old[f"v{place[c]}"] - new[f"v{i}"] if c in place else 0
                    if lost > 0:
                        nulled[c] = lost
            flagged = sum(new[f"f{i}"] for i, c in enumerate(after.flags) if c not in before.columns)
            out.append(Step(position, after.name, old["rows"], new["rows"], nulled, flagged))
        return out

    def rows(self) -> tuple[int, int]:
        """Rows before the first step and behind the last."""
        return self._points[0].read()["rows"], self._points[-1].read()["rows"]

    def checked(self, rows_in: int, rows_out: int) -> bool:
        return self.rows() == (rows_in, rows_out)


class NoLog(StepLog):
    """Applies steps without observing them."""

    def _observed(self, df: DataFrame, name: str, renamed: Mapping[str, str]) -> DataFrame:
        return df

    def step(self, df, name, function, *args, renamed=None) -> DataFrame:
        return function(df, *args)


def step_table(spark: SparkSession, logs: Mapping[str, list[Step]]) -> DataFrame:
    """All steps of several chains as one table, with the name of the chain first."""
    rows = [(chain, *s.row()) for chain, steps in logs.items() for s in steps]
    return spark.createDataFrame(rows, f"chain string, {SCHEMA}")


def count_steps(df: DataFrame, chain: Callable[[DataFrame, StepLog], DataFrame]) -> list[Step]:
    """Runs a chain for its counts alone."""
    log = StepLog()
    chain(df, log).write.format("noop").mode("overwrite").save()
    return log.steps()


def observed_delta(df: DataFrame, name: str, function: Callable[..., DataFrame], *args) -> DataFrame:
    """One row with the counts around a step, as ``row_delta`` has them; the step runs once."""
    (step,) = count_steps(df, lambda d, log: log.step(d, name, function, *args))
    delta = step.rows_out - step.rows_in
    change = "removed" if delta < 0 else "added" if delta > 0 else "unchanged"
    return df.sparkSession.createDataFrame(
        [(step.rows_in, step.rows_out, delta, change)], "rows_before long, rows_after long, delta long, change string"
    )
