"""Sinks: whole-table parquet writes whose row counts cost no extra job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int
    schema: str


#: How a job writes a table to a path, and reads one from it.
Writer = Callable[[DataFrame, str], WriteResult]
Reader = Callable[[SparkSession, str], DataFrame]


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> WriteResult:
    """Overwrite a snappy parquet table and report rows and schema.

    The count is observed during the write. Partitioned tables are rebalanced by their
    partition columns first, so each directory gets few, evenly sized files and a hot
    partition is still written by many tasks. ``files=1`` is for tiny tables only.
    """
    observed = Observation()
    out = df.hint("rebalance", *partition_by) if partition_by and not files else df
    # Observed behind the shuffle: its map tasks may run again and would count twice.
    out = out.observe(observed, F.count(F.lit(1)).alias("rows"))
    if files:
        out = out.coalesce(files)
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return WriteResult(path, observed.get["rows"], df.schema.simpleString())
