"""Operators as stages: documents in, documents out.

Every stage keeps the columns of its input and their order. What an operator decides takes
effect: rejected rows are gone, texts are replaced and ``n_chars`` follows them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.mixing import copies_in_order
from siltbed.llm.near_dedup import with_group
from siltbed.llm.packing import pack_documents
from siltbed.llm.pii import mask_pii
from siltbed.llm.quality_rules import quality_rules
from siltbed.llm.simhash import fingerprint_roots, fingerprints
from siltbed.sources.session import staged


def as_rows(docs: DataFrame) -> DataFrame:
    """(row, text): all columns as one, so that no name of theirs can clash, and the text."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))


def unpacked(rows: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The columns of ``row`` in their order, with another text if one is given."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in columns])


def keep_quality(docs: DataFrame) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    judged = quality_rules(as_rows(docs)).where("kept")
    return unpacked(judged, docs.columns, F.col("cleaned_text"))


def one_row_of_each(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly one row per ``group`` of (row, group), whatever ids the rows have.

    The smallest id stays, then the smallest text, then the smallest of the other columns; a
    row without an id only where no row of its group has one.
    """
    doc_id, text = F.col("row")["doc_id"], F.col("row")["text"]
    others = [F.col("row")[c].alias(c) for c in columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(F.lit(0).alias("_"), *others)) if others else F.lit("")
    order = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), text.alias("text"), rest.alias("rest"))
    return unpacked(grouped.groupBy("group").agg(F.min_by("row", order).alias("row")), columns)


def keep_one_of_each_near_group(docs: DataFrame) -> DataFrame:
    """One row of every group of rows whose five-word shingles have a similarity of 0.8 or more."""
    return one_row_of_each(with_group(docs), docs.columns)


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of every group of op2, whose SimHash of three-word shingles has a radius of 3."""
    marked = staged(fingerprints(as_rows(docs), "row", "text"))
    roots = fingerprint_roots(marked.select("fingerprint").distinct())
    grouped = marked.join(roots, "fingerprint").select("row", F.col("root").alias("group"))
    return one_row_of_each(grouped, docs.columns)


def mask(docs: DataFrame) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return unpacked(mask_pii(as_rows(docs)), docs.columns, F.col("text"))


def mix(docs: DataFrame) -> DataFrame:
    """Documents repeated or left out so that sources weigh as the root of their size."""
    return copies_in_order(docs).drop("mix_copy", "mix_key").toDF(*docs.columns)


def pack(docs: DataFrame) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack_documents(docs)
