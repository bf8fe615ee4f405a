"""Scans and sinks: CSV, partitioned tables, landed series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.key_tables import append_members, read_members, with_member_codes
from siltbed.sources.published import publish_keys, publish_table, read_published
from siltbed.sources.readers import concat_bars, read_csv, read_table
from siltbed.sources.session import staging_path
from siltbed.sources.split_csv import read_split_csv
from siltbed.sources.writers import write_table
from siltbed.workload.registry import query, table
from siltbed.workload.series import BARS_SQL, bars


@query("""
SELECT p_partkey, p_name || chr(10) || '"' || p_brand || '", ' || p_type AS description, p_size, p_retailprice
FROM part""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred types and quoted multi-line text survive a CSV landing."""
    text = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", '), "p_type")
    parts = table(spark, sf_dir, "part").select("p_partkey", text.alias("description"), "p_size", "p_retailprice")
    path = staging_path(spark)
    parts.write.options(header=True, escape='"').csv(path)
    return read_csv(spark, path)


@query("SELECT doc_id, source, text FROM documents")
def split_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with their line breaks and quotes from CSV files that many tasks read."""
    path = staging_path(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    documents.write.options(header=True, escape='"').csv(path)
    return read_split_csv(spark, path, documents.schema).rows


@query("""
SELECT p_size, count(*) AS n_parts FROM (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 'malformed' ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part)
GROUP BY p_size""")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by size, those whose size is no number by the reason they are quarantined for."""
    path = staging_path(spark)
    broken = F.col("p_partkey") % 3 == 0
    size = F.when(broken, F.lit("two\nlines")).otherwise(F.col("p_size").cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", size.alias("p_size"), F.concat("p_name", F.lit('\n"')).alias("name"))
    parts.write.options(header=True, escape='"').csv(path)
    read = read_split_csv(spark, path, "p_partkey bigint, p_size int, name string")
    sizes = read.rows.select(F.col("p_size").cast("string").alias("p_size"))
    reasons = read.quarantine.select(F.col("reason").alias("p_size"))
    return sizes.unionByName(reasons).groupBy("p_size").agg(F.count(F.lit(1)).alias("n_parts"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by key, read back with the key discovered and other keys' folders skipped."""
    path = staging_path(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_table(orders, path, ["o_orderpriority"])
    return read_table(spark, path).filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same layout read as plain files: all rows, no discovered column."""
    path = staging_path(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_table(orders, path, ["o_orderpriority"])
    return read_table(spark, path, recursive=True)


@query(f"""
WITH {BARS_SQL}
SELECT CAST(date AS VARCHAR) AS "Date", 'WHOLE' AS "Ticker", open AS "Open", high AS "High", low AS "Low",
       close AS "Close", (open + close) / 2 AS "Adj Close", volume AS "Volume" FROM bars
UNION ALL
SELECT CAST(date AS VARCHAR), 'PLAIN', open, high, low, close, close, volume FROM bars""")
def landed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed series in standard columns; one lacks the adjusted close, both name the date oddly."""
    landed = bars(spark, sf_dir).select(
        F.col("date").alias("index"),
        *[F.col(c).alias(c.title()) for c in ("open", "high", "low", "close")],
        ((F.col("open") + F.col("close")) / 2).alias("Adj Close"),
        F.col("volume").cast("int").alias("Volume"),
    )
    return concat_bars({"WHOLE": landed, "PLAIN": landed.drop("Adj Close")})


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders""")
def published_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status published anew: its rows change, those of the others stay where they are."""
    path = staging_path(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    publish_keys(orders, path, ["o_orderstatus"])
    filled = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    publish_keys(filled, path, ["o_orderstatus"])
    return read_published(spark, path)


@query("""
SELECT 1 AS version, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT 2, o_orderpriority, count(*) FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority""")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose second version is made from its first; both can be read."""
    path = staging_path(spark)
    publish_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    publish_table(read_published(spark, path).filter("o_totalprice > 100000"), path)
    counts = [
        read_published(spark, path, v).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(v).alias("version"), "o_orderpriority", "n")
        for v in (1, 2)
    ]
    return counts[0].unionByName(counts[1])


@query("""
WITH old AS (SELECT DISTINCT p_brand FROM part WHERE p_size <= 5),
first AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code, 1 AS batch FROM old),
later AS (
  SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 + (SELECT count(*) FROM old) AS code, 2 AS batch
  FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL EXCEPT SELECT p_brand FROM old)),
coded AS (SELECT * FROM first UNION ALL SELECT * FROM later)
SELECT p_brand AS member, code, batch, count(*) AS n_parts FROM coded JOIN part USING (p_brand) GROUP BY ALL""")
def member_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of small parts are numbered first; a second run over all keeps these codes."""
    path = staging_path(spark)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    append_members(parts.filter("p_size <= 5"), "p_brand", path)
    append_members(parts, "p_brand", path)
    counts = with_member_codes(parts, "p_brand", "code", path).groupBy("code").agg(F.count(F.lit(1)).alias("n_parts"))
    return read_members(spark, path).join(counts, "code").select("member", "code", "batch", "n_parts")


@query("""
SELECT doc_id, row_number() OVER (ORDER BY text) - 1 AS code
FROM (SELECT min(doc_id) AS doc_id, text FROM documents WHERE text IS NOT NULL GROUP BY text)""")
def text_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as members, numbered in slices of their order; each by its first document."""
    path = staging_path(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    append_members(documents, "text", path)
    coded = with_member_codes(documents.dropna(subset=["text"]), "text", "code", path)
    return coded.groupBy("code").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "code")
