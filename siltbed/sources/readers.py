"""Scans: CSV, layer tables, landed frames and typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.errors import MissingInputError
from siltbed.operators.dimensional import union_all


def _guarded(path: str, what: str, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingInputError(f"{what} not found at '{path}'") from error
        raise


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with header, multi-line quoted fields and doubled quotes.

    For large inputs pass a ``schema``, as Spark reads the files once more to infer one, and
    ``multi_line=False`` where no field holds a line break: files with such fields cannot be
    split, so each is one task.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"')
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return _guarded(path, "CSV input", lambda: reader.csv(path))


def read_table(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Parquet table. Partition directories become columns unless ``recursive`` is set."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return _guarded(path, "table", lambda: reader.parquet(path))


def read_tables(
    spark: SparkSession, root: str, names: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Several tables as ``{name: relative path}`` below one root; lazy, so unused ones cost nothing."""
    return {name: read_table(spark, f"{root}/{path}") for name, path in names.items()}


def rows_frame(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Few rows with a declared schema; no rows give an empty typed table."""
    return spark.createDataFrame(list(rows), schema)


def landed_bars(frame: DataFrame, ticker: str | None = None) -> DataFrame:
    """Landed daily bars in the standard column order and types.

    ``Ticker`` is added when the file covers one series, ``Adj Close`` falls back to
    ``Close``, an ``index`` column is the date, and the date is kept as text.
    """
    if "index" in frame.columns and "Date" not in frame.columns:
        frame = frame.withColumnRenamed("index", "Date")
    if ticker is not None:
        frame = frame.withColumn("Ticker", F.lit(ticker))
    if "Adj Close" not in frame.columns:
        frame = frame.withColumn("Adj Close", F.col("Close"))
    return frame.select(
        F.col("Date").cast("string").alias("Date"),
        F.col("Ticker").cast("string").alias("Ticker"),
        *[F.col(c).cast("double").alias(c) for c in ("Open", "High", "Low", "Close", "Adj Close")],
        F.col("Volume").cast("bigint").alias("Volume"),
    )


def concat_bars(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All landed series in one table; an empty mapping is an error."""
    if not frames:
        raise MissingInputError("no landed series: nothing to concatenate")
    return union_all([landed_bars(df, ticker) for ticker, df in frames.items()])
