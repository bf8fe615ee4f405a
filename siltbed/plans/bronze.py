"""Raw files to bronze: faithful parquet copies with an advisory quality report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from siltbed.functions import url_category
from siltbed.operators.html_rows import html_rows
from siltbed.operators.quality import profile, validation_report
from siltbed.plans import fixed_values as fixed
from siltbed.sources.readers import concat_bars, landed_bars, read_csv, read_table, rows_frame
from siltbed.sources.writers import WriteResult, write_table

BAR_TYPES = {
    "Date": StringType(),
    "Ticker": StringType(),
    **{c: DoubleType() for c in ("Open", "High", "Low", "Close", "Adj Close")},
    "Volume": LongType(),
}
PRICE_SCHEMA = ", ".join(f"{c} string" for c in fixed.PRICE_COLUMNS)


@dataclass
class IngestReport:
    """What a run wrote, how good it is (one lazy report per table) and what failed."""

    written: dict[str, WriteResult] = field(default_factory=dict)
    quality: dict[str, DataFrame] = field(default_factory=dict)
    profiles: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def ingest_panels(
    spark: SparkSession,
    raw: str,
    lake: str,
    datasets: Iterable[str] = tuple(fixed.PANEL_SCHEMAS),
    multi_line: bool = True,
) -> IngestReport:
    """Each named CSV to its own bronze table; a failing one does not stop the others.

    Reports are lazy and read the written parquet, so the CSV is parsed for the copy only.
    """
    report = IngestReport()
    for name in datasets:
        path = f"{lake}/{fixed.BRONZE_PANELS}/{name}"
        try:
            report.written[name] = write_table(
                read_csv(spark, f"{raw}/{name}.csv", multi_line=multi_line), path
            )
        except Exception as error:  # noqa: BLE001 - isolated per dataset and reported
            report.failures[name] = str(error)
            continue
        stored = read_table(spark, path)
        report.quality[name] = validation_report(stored, name)
        report.profiles[name] = profile(stored)
    return report


def _ingest(report_name: str, df: DataFrame, path: str, partition_by: Sequence[str], **checks) -> IngestReport:
    report = IngestReport()
    report.written[report_name] = write_table(df, path, partition_by)
    # The stored table is reported on, so that sources are not read again.
    report.quality[report_name] = validation_report(read_table(df.sparkSession, path), report_name, **checks)
    return report


def ingest_bars(
    spark: SparkSession, landed: DataFrame | Mapping[str, DataFrame], lake: str
) -> IngestReport:
    """Landed daily bars (one frame, or one per ticker) to bronze, partitioned by ticker."""
    bars = landed_bars(landed) if isinstance(landed, DataFrame) else concat_bars(landed)
    return _ingest(
        "yahoo",
        bars,
        f"{lake}/{fixed.BRONZE_BARS}",
        ["Ticker"],
        expected_columns=fixed.BAR_COLUMNS,
        expected_types=BAR_TYPES,
        date_column="Date",
    )


def price_rows(pages: DataFrame, url: str = "url", html: str = "html", **layout) -> DataFrame:
    """Price observations on stored pages, with the category taken from the URL."""
    fields = ["Date", "Product", "Price", "Unit"]
    rows = html_rows(pages, html, [url], fields, **layout)
    return rows.select(*fields, url_category(F.col(url)).alias("Category"))


def ingest_prices(spark: SparkSession, pages: DataFrame | None, lake: str, **layout) -> IngestReport:
    """Stored price pages to bronze; without pages the table is empty but typed."""
    rows = rows_frame(spark, [], PRICE_SCHEMA) if pages is None else price_rows(pages, **layout)
    return _ingest(
        "trendforce",
        rows,
        f"{lake}/{fixed.BRONZE_PRICES}",
        [],
        expected_columns=fixed.PRICE_COLUMNS,
        date_column="Date",
    )


def run_sources(jobs: Mapping[str, Callable[[], IngestReport]]) -> IngestReport:
    """Run the given sources; one that fails is reported and the others go on."""
    total = IngestReport()
    for name, job in jobs.items():
        try:
            part = job()
        except Exception as error:  # noqa: BLE001 - isolated per source and reported
            total.failures[name] = str(error)
            continue
        for kind in ("written", "quality", "profiles", "failures"):
            getattr(total, kind).update(getattr(part, kind))
    return total
