"""Queries of the operators that are column expressions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.mixing import mix_sources
from siltbed.llm.pii import BASE_KINDS, find_pii, spans_text
from siltbed.llm.quality_rules import BOILERPLATE, quality_rules
from siltbed.llm.registry import query, table
from siltbed.llm.url_filter import filter_urls

WORDS_SQL = "[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> '']"
PHRASES_SQL = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)


@query(
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS body, {WORDS_SQL} AS w FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8
    ),
    keyed AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS k FROM windows),
    twice AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM keyed) WHERE n > 1
    ),
    covered AS (
        SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
    ),
    lines AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d),
    measured AS (
        SELECT doc_id, line,
            length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars,
            length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS symbols,
            length(regexp_replace(line, '[^|»›•]+', '', 'g')) AS separators,
            len([x FOR x IN regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+') IF x <> '']) AS n
        FROM lines
    ),
    failing AS (
        SELECT doc_id, sum(chars) AS lost FROM measured
        WHERE chars > 0 AND ({PHRASES_SQL} OR (separators >= 3 AND 3 * separators >= n)
            OR 100 * symbols > 30 * chars OR NOT regexp_matches(line, '[\\p{{L}}\\p{{N}}]'))
        GROUP BY doc_id
    ),
    worded AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM measured WHERE chars > 0 GROUP BY doc_id
    ),
    s AS (
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
            CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN worded USING (doc_id) LEFT JOIN failing USING (doc_id)
    )
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
            AND NOT (100 * lost_chars > 50 * word_chars) AS kept
    FROM s
    """
)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept"
    )


#: The rules of the URL query (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Listed hosts; a host stands for every address on it and its subdomains.
LISTED_HOSTS = (
    "adult-x.example.com",
    "adult-x.example.net",
    "ads-track.example.com",
    "ads-track.example.net",
    "casino-win.example.com",
    "casino-win.example.net",
    "free-bets.example.com",
    "free-bets.example.net",
    "spam-farm.example.com",
    "spam-farm.example.net",
)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


@query(
    f"""
    WITH u AS (
        SELECT page_id, coalesce(url, '') AS url FROM pages
    ), j AS (
        SELECT page_id,
            translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path
        FROM u
    ), r AS (SELECT * FROM (VALUES {_values(RULES)}) AS t(r_host, r_path, r_verdict)),
    l AS (SELECT * FROM (VALUES {_values((h,) for h in LISTED_HOSTS)}) AS t(l_host)),
    fits AS (
        SELECT page_id, r_host || r_path AS rule, r_verdict,
            row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC) AS n
        FROM j JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    ),
    bad AS (SELECT DISTINCT page_id FROM j JOIN l ON host = l_host OR ends_with(host, '.' || l_host))
    SELECT j.page_id, host, path, rule,
        coalesce(r_verdict, CASE WHEN bad.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
    FROM j LEFT JOIN (SELECT * FROM fits WHERE n = 1) f ON j.page_id = f.page_id LEFT JOIN bad ON bad.page_id = j.page_id
    """
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and listed hosts against every page's URL."""
    rows = [(h, p, v, True) for h, p, v in RULES] + [(h, "", "block", False) for h in LISTED_HOSTS]
    entries = spark.createDataFrame(rows, "host string, path string, verdict string, is_rule boolean")
    return filter_urls(table(spark, sf_dir, "pages"), entries)


@query(
    """
    WITH sizes AS (
        SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars FROM documents GROUP BY source
    ), weights AS (
        SELECT source, chars, CASE WHEN chars > 0 THEN sqrt(chars) ELSE 0.0 END AS weight FROM sizes
    ), rates AS (
        SELECT source, CASE WHEN weight > 0
            THEN weight / (SELECT sum(weight) FROM weights) * (SELECT sum(chars) FROM weights) / chars ELSE 0.0 END AS rate
        FROM weights
    ), terms AS (
        SELECT source, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k, rate FROM rates
    ), cdf AS (
        SELECT source, k, sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) WHEN k = 0 THEN 1.0 ELSE 0.0 END)
            OVER (PARTITION BY source ORDER BY k) AS p
        FROM terms
    ), drawn AS (
        SELECT doc_id, source,
            CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
        FROM documents
    ), copies AS (
        SELECT doc_id, drawn.source,
            (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM drawn.source AND cdf.p <= u) AS n
        FROM drawn
    ), exploded AS (SELECT doc_id, source, unnest(range(1, n + 1)) AS mix_copy FROM copies)
    SELECT doc_id, source, mix_copy, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || mix_copy) AS mix_key,
        sha256(coalesce(text, '')) AS text_sha256
    FROM exploded JOIN documents USING (doc_id, source)
    """
)
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the square roots of their sources' sizes."""
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_copy", "mix_key", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents.

    Built on ``find_pii``; tested against a plain Python search, which has the same
    patterns without possessive repeats and look-arounds.
    """
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.select("doc_id", "base_spans", "added_spans")
    of = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.concat("base_spans", "added_spans")).alias("spans"),
    )


query()(op3_pii)
