"""Tables that are made from each other, written side by side.

A job writes one table and names the jobs whose tables it reads. Jobs with all they need run
at the same time, each in a thread of the driver that does nothing but wait for Spark. With
``spark.scheduler.mode`` FAIR a small table does not wait behind a large one. A job that fails
stops those that need its table and no other.

With ``record`` every finished job leaves a row in a table, and the next call with the same
record runs only what is not finished. A new record starts anew.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources.writers import WriteResult

RECORD = "job string, path string, rows bigint, schema string, finished_at timestamp"


@dataclass(frozen=True)
class Job:
    """What writes a table, and the names of the jobs that must have written theirs before."""

    write: Callable[[], WriteResult]
    needs: tuple[str, ...] = ()


@dataclass
class RunReport:
    """Tables written now, tables kept from earlier calls, errors, and jobs left out for them."""

    written: dict[str, WriteResult] = field(default_factory=dict)
    kept: dict[str, WriteResult] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    left_out: dict[str, list[str]] = field(default_factory=dict)


class TablesOnDemand(dict):
    """Tables read when first asked for, so that a missing one fails only the job that asks."""

    def __init__(self, read: Callable[[str], DataFrame]):
        super().__init__()
        self._read = read

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._read(name)
        return self[name]


def finished_jobs(spark: SparkSession, record: str) -> dict[str, WriteResult]:
    """The jobs a record names; none where it does not exist yet."""
    try:
        rows = spark.read.schema(RECORD).parquet(record).orderBy("finished_at").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.job: WriteResult(r.path, r.rows, r.schema) for r in rows}


def _note(spark: SparkSession, record: str, job: str, result: WriteResult) -> None:
    row = spark.range(1).select(
        F.lit(job).alias("job"),
        F.lit(result.path).alias("path"),
        F.lit(result.rows).cast("bigint").alias("rows"),
        F.lit(result.schema).alias("schema"),
        F.current_timestamp().alias("finished_at"),
    )
    row.coalesce(1).write.mode("append").parquet(record)


def run_jobs(
    spark: SparkSession, jobs: Mapping[str, Job], record: str | None = None, width: int = 4
) -> RunReport:
    """Run all jobs, at most ``width`` at a time, each after those it needs.

    A finished job is kept only if all it needs are kept too. Errors are reported, not
    raised; unknown needs and circles are errors of the caller and raise at once.
    """
    unknown = {n for job in jobs.values() for n in job.needs} - set(jobs)
    if unknown:
        raise ValueError(f"jobs need tables that no job writes: {sorted(unknown)}")
    order = TopologicalSorter({name: job.needs for name, job in jobs.items()})
    order.prepare()
    before = finished_jobs(spark, record) if record else {}
    report, running = RunReport(), {}

    def work(name: str) -> WriteResult:
        # Names the jobs in Spark's pages, and lets a caller cancel one table.
        spark.sparkContext.setJobGroup(name, f"write {name}")
        return jobs[name].write()

    def settle(ended: Future, name: str) -> None:
        order.done(name)
        error = ended.exception()
        if error is not None:
            report.failures[name] = str(error)
            return
        report.written[name] = ended.result()
        if record:
            # Noted by this thread alone: appends to one path must not meet.
            _note(spark, record, name, report.written[name])

    with ThreadPoolExecutor(width) as pool:
        while order.is_active():
            for name in order.get_ready():
                needs = jobs[name].needs
                missing = [n for n in needs if n in report.failures or n in report.left_out]
                if missing:
                    report.left_out[name] = missing
                    order.done(name)
                elif name in before and all(n in report.kept for n in needs):
                    report.kept[name] = before[name]
                    order.done(name)
                else:
                    running[pool.submit(work, name)] = name
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                settle(ended, running.pop(ended))
    return report
