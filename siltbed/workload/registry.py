"""Registry of queries and table access shared by the workload modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its (or the given) name, with the SQL for the same rows."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round floating results for comparison; adding 0.0 removes the sign of zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})
