"""CSV files whose quoted fields hold line breaks, each read by many tasks.

A line belongs to a quoted field or not depending on all quotes before it, which is why such
files are commonly read by one task each. Here a line is a function of the state it is entered
in (outside or inside a quoted field): it keeps the state, switches it or forces one. These
functions compose, so every byte range of a file is summed up on its own, the few summaries are
scanned per file, and each range then knows the state it begins in. Lines of a record that spans
lines are put together by its first line; all other lines are records already.

The text is shuffled once, by byte range; there is no Python code and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from siltbed.errors import MissingInputError

#: Lines a record may span; longer ones are quarantined line by line.
MOST_LINES = 10_000

_RAW = "_raw_record"


@dataclass(frozen=True)
class CsvRows:
    """Parsed rows, and what could not be parsed: ``file, range_start, line, reason, raw``.

    ``line`` counts from 1 within the byte range that begins at ``range_start``.
    """

    rows: DataFrame
    quarantine: DataFrame


def _ends_inside(line: Column, delimiter: str) -> Column:
    """Whether a line entered outside a quoted field ends within one.

    Complete fields, then an open quote. A quote opens a field only as its first character.
    All repeats are possessive, so matching is linear and needs no stack.
    """
    d = "\\x{%x}" % ord(delimiter)
    quoted = '"(?:[^"]++|"")*+'
    complete = f'(?:{quoted}"[^{d}]*+|[^"{d}][^{d}]*+)?+{d}'
    return line.rlike(f"\\A(?s:(?:{complete})*+{quoted}\\z)")


def _with_states(df: DataFrame, outside: str, inside: str, window) -> DataFrame:
    """Adds ``_after_0`` and ``_after_1``: the state after each row, by the state at the window's start.

    ``outside`` and ``inside`` name the state a row leaves if it is entered in the one or the other.
    """
    switched = F.col(outside) & ~F.col(inside)
    turns = F.sum(switched.cast("int")).over(window) % 2 == 1
    # A forced state is kept as seen through the turns so far: later turns then apply to it.
    df = df.withColumn("_forced", F.when(F.col(outside) == F.col(inside), F.col(outside) != turns))
    forced = F.last("_forced", ignorenulls=True).over(window)
    return df.withColumns(
        {f"_after_{s}": F.coalesce(forced, F.lit(bool(s))) != turns for s in (0, 1)}
    )


def csv_lines(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Physical lines with what is needed to join them to records.

    ``file, range_start, line, raw, first, continued, start_range, start_line``: ``first`` marks lines that begin a
    record, ``continued`` those whose record goes on in the next line; the last two name the
    line that begins the record.
    """
    try:
        scan = spark.read.text(path, lineSep="\n")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(f"CSV input not found at '{path}'") from error
        raise
    lines = scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("_place"),
        F.col("value").alias("raw"),
    )
    # A line entered inside a quoted field is one entered outside that begins with the quote.
    lines = lines.withColumns(
        {
            "_outside": _ends_inside(F.col("raw"), delimiter),
            "_inside": _ends_inside(F.concat(F.lit('"'), "raw"), delimiter),
        }
    )
    placed = Window.partitionBy("file", "range_start").orderBy("_place")
    so_far = placed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = _with_states(lines, "_outside", "_inside", so_far).withColumn("line", F.row_number().over(placed))
    for state in (0, 1):
        before = F.lag(f"_after_{state}", 1, bool(state)).over(placed)
        lines = lines.withColumn(f"_before_{state}", before)

    summaries = lines.groupBy("file", "range_start").agg(
        *[F.max_by(f"_after_{s}", "line").alias(f"_leaves_{s}") for s in (0, 1)],
        *[F.max(F.when(~F.col(f"_before_{s}"), F.col("line"))).alias(f"_start_{s}") for s in (0, 1)],
    )
    ranges = Window.partitionBy("file").orderBy("range_start")
    ranges_so_far = ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    last_start = F.when(F.col("_entered"), F.col("_start_1")).otherwise(F.col("_start_0"))
    begun = F.when(last_start.isNotNull(), F.struct("range_start", last_start.alias("line")))
    entered = (
        _with_states(summaries, "_leaves_0", "_leaves_1", ranges_so_far)
        .withColumn("_entered", F.lag("_after_0", 1, False).over(ranges))
        .withColumn("_begun", begun)
        .select("file", "range_start", "_entered", F.last("_begun", ignorenulls=True).over(earlier).alias("_open"))
    )

    def by_state(name: str) -> Column:
        return F.when(F.col("_entered"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    stated = lines.join(entered, ["file", "range_start"]).withColumns(
        {"first": ~by_state("_before"), "continued": by_state("_after")}
    )
    started = F.last(
        F.when(F.col("first"), F.struct("range_start", "line")), ignorenulls=True
    ).over(Window.partitionBy("file", "range_start").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    start = F.coalesce(started, F.col("_open"))
    return stated.select(
        "file", "range_start", "line", "raw", "first", "continued",
        start["range_start"].alias("start_range"), start["line"].alias("start_line"),
    )


def read_split_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    delimiter: str = ",",
    header: bool = True,
    options: Mapping[str, str] | None = None,
    most_lines: int = MOST_LINES,
) -> CsvRows:
    """CSV with quoted line breaks and doubled quotes, read by as many tasks as the files have ranges.

    Rows equal those of Spark's multi-line reader with ``escape='"'`` for well-formed records, but
    that line breaks within fields stay as they are in files whose lines end in ``\\r\\n``. In the
    quarantine come, instead of rows:

    * ``malformed``: records with too few or too many fields or a value not of its type;
    * ``unclosed``: the lines from an opening quote that no later line of the file closes;
    * ``too_long``: the lines of records over more than ``most_lines`` lines.

    So a stray quote never gathers the rest of a file in one task. Empty lines are skipped. With
    ``header`` the first record of each file is skipped, whatever its names. Compressed files
    have one range, as they cannot be split.
    """
    typed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    lines = csv_lines(spark, path, delimiter)
    if header:
        lines = lines.filter((F.col("start_range") != 0) | (F.col("start_line") != 1))
    key = ["file", "start_range", "start_line"]
    whole = lines.filter(F.col("first") & ~F.col("continued"))
    parts = lines.filter(~F.col("first") | F.col("continued"))
    sizes = parts.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_lines"), F.count_if(~F.col("continued")).alias("_closed")
    )
    reason = F.when(F.col("_closed") == 0, "unclosed").when(F.col("_lines") > most_lines, "too_long")
    judged = parts.join(sizes, key).withColumn("reason", reason)
    place = F.struct("range_start", "line", "raw")
    joined = (
        judged.filter(F.col("reason").isNull())
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(place)).alias("_parts"))
        .select(*key, F.array_join(F.col("_parts")["raw"], "\n").alias("raw"))
    )
    records = whole.select(*key, "raw").unionByName(joined)
    records = records.withColumn("raw", F.regexp_replace("raw", r"\r\z", "")).filter("raw <> ''")

    kept = StructType([*typed.fields, StructField(_RAW, StringType())])
    settings = {
        "sep": delimiter,
        "escape": '"',
        "multiLine": "true",
        "mode": "PERMISSIVE",
        **(options or {}),
        "columnNameOfCorruptRecord": _RAW,
    }
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    parsed = records.withColumn("_row", F.from_csv("raw", ddl, settings))
    bad = F.col("_row")[_RAW].isNotNull()
    rows = parsed.filter(~bad).select(*[F.col("_row")[f.name].alias(f.name) for f in typed.fields])
    malformed = parsed.filter(bad).select(
        "file", F.col("start_range").alias("range_start"), F.col("start_line").alias("line"),
        F.lit("malformed").alias("reason"), "raw",
    )
    lines_left = judged.filter(F.col("reason").isNotNull()).select("file", "range_start", "line", "reason", "raw")
    return CsvRows(rows, malformed.unionByName(lines_left))
