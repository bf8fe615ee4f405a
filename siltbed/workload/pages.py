"""Rows and categories from stored web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import url_category
from siltbed.operators.html_rows import html_rows
from siltbed.workload.registry import query, table


@query(r"""
SELECT page_id, url, coalesce(nullif(regexp_extract(
         regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*', ''), '([^/]*)/*$', 1), ''),
       'general') AS category
FROM pages""", name="url_category")
def page_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("category", url_category(F.col("url")))


@query(r"""
WITH lists AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '(?s)<li>(.*?)</li>', 1) AS items
  FROM pages),
items AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS n FROM lists)
SELECT page_id, CAST(n - 1 AS INT) AS row_number,
       trim(replace(regexp_extract(item, '<a [^>]*>(.*?)</a>', 1), '&amp;', '&')) AS label, '' AS detail
FROM items WHERE n > 1""", name="html_rows")
def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first list on each page; the first entry is a header, the second field is absent."""
    return html_rows(
        table(spark, sf_dir, "pages"),
        "html",
        ["page_id"],
        ["label", "detail"],
        required=1,
        container="ul",
        row="li",
        cells=["a"],
    )
