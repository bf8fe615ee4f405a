"""Queries on pages, vectors and benchmark items; the last two have SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm.html_text import extract_text
from siltbed.llm.ranked_search import ranked_search
from siltbed.llm.registry import query, table
from siltbed.llm.vector_codes import vector_codes


@query()
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract_text(table(spark, sf_dir, "pages"))


def _round(n: int) -> str:
    """Assignment to the codebooks of round ``n`` and the codebooks that follow."""
    return f"""
    a{n} AS (
        SELECT p.vec_id, p.p, min(CAST(d2 AS BIGINT) * 64 + e) AS best
        FROM (
            SELECT parts.vec_id, parts.p, e, (parts.v[1] - b{n}.v[1]) ** 2 + (parts.v[2] - b{n}.v[2]) ** 2
                + (parts.v[3] - b{n}.v[3]) ** 2 + (parts.v[4] - b{n}.v[4]) ** 2 AS d2
            FROM parts JOIN b{n} ON b{n}.p = parts.p
        ) AS p GROUP BY p.vec_id, p.p
    ),
    m{n} AS (
        SELECT p, e, list(mean ORDER BY i) AS v FROM (
            SELECT a.p, a.best % 64 AS e, i, CAST(floor(CAST(sum(parts.v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS mean
            FROM a{n} AS a JOIN parts ON parts.vec_id = a.vec_id AND parts.p = a.p, range(1, 5) AS r(i)
            GROUP BY a.p, a.best % 64, i
        ) GROUP BY p, e
    ),
    b{n + 1} AS (SELECT b{n}.p, b{n}.e, coalesce(m{n}.v, b{n}.v) AS v FROM b{n} LEFT JOIN m{n} USING (p, e))"""


@query(
    f"""
    WITH kept AS (
        SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ),
    parts AS (SELECT vec_id, p, q[4 * p + 1 : 4 * p + 4] AS v FROM kept, range(16) AS r(p)),
    b0 AS (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts QUALIFY e < 64
    ),{_round(0)},{_round(1)},{_round(2)},
    coded AS (
        SELECT vec_id, string_agg(lower(lpad(to_hex(best % 64), 2, '0')), '' ORDER BY p) AS code,
            CAST(sum(best // 64) AS BIGINT) AS error
        FROM a2 GROUP BY vec_id
    ),
    digest AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2
    )
    SELECT vec_id, code, error,
        CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest
    """
)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)


@query(
    f"""
    WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
    lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
    asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    postings AS (
        SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
    ),
    weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM postings, whole GROUP BY term
    ),
    scored AS (
        SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
        FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
        GROUP BY item_id, doc_id
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 50
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
