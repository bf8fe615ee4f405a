"""Column-expression operators against plain Python and against their SQL."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import stages
from siltbed.llm.mixing import mix_sources, poisson_cdf, poisson_draw, source_rates
from siltbed.llm.pii import BASE_KINDS, find_pii, mask_pii
from siltbed.llm.quality_rules import quality_rules
from siltbed.llm.url_filter import filter_urls
from siltbed.llm.workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", ["op3_pii", "op8_quality_rules", "op9_url_filter", "op10_source_mixing"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|NestedLoop", plan)


# -- PII -----------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, m: str) -> bool:
    d = [int(c) for c in m if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k in BASE_KINDS for m in re.finditer(BASE[k], text) if passes(k, m[0])]


TEXTS = [
    None,
    "",
    "a@b.c-d@e.f x_y%z+q@h.i.j, a@b.c_d@e.f @x.y a@b",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.4 1.2.3 é1.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 41111111111111112 5 4111  1111 1111 1111 1111",
    "x4111111111111111y 4111111111111111 4111111111111111 00000000000000000000 0000000000000000000",
    "+1 (017) 555-7713 +123 +4 9 (30) 12.34-56) ++49 30 1234567 +1234567890123456",
    "😀 mail me: ü@b.de or x@b.de, ip 😀10.0.0.1",
    "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433 account",
    "ssn 123-45-6789 but 123-45-6789" + " " * 60 + "123-45-6789; call (499) 555-6503",
    "9" * 20_000,
    "a" * 20_000 + "@" + "b." * 5_000 + "c",
    "1." * 9_000,
]


def test_base_spans_equal_plain_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in find_pii(docs).collect():
        assert [(s.kind, s.s, s.e) for s in r.base_spans] == plain_spans(r.text or ""), r.doc_id


def test_base_spans_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op3_pii"](spark, SF_DIR).collect()}
    for r in docs.collect():
        spans = plain_spans(r.text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert got[r.doc_id].spans.startswith(joined)
        assert got[r.doc_id].n_card == sum(k == "card" for k, _, _ in spans)


def test_added_spans_need_a_check_or_a_cue(spark):
    docs = spark.createDataFrame([(8, TEXTS[8]), (9, TEXTS[9])], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.s) for s in r.added_spans] for r in find_pii(docs).collect()}
    assert got[8] == [("iban", 0)]
    assert got[9] == [("national_id", 4), ("national_id", 20), ("local_phone", TEXTS[9].index("(499"))]


def test_masking_keeps_the_rest(spark):
    rows = [(1, "to x@b.de, 10.0.0.1!", 7), (2, None, 8), (3, "clean", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base_spans int")
    got = sorted(map(tuple, mask_pii(docs).collect()))
    assert got == [(1, "to [email], [ip]!", 7), (2, None, 8), (3, "clean", 9)]


# -- quality, URLs, mixing: awkward rows -----------------------------------------------------


def test_quality_of_awkward_rows(docs, rows, no_docs, spark):
    got = quality_rules(docs).collect()
    assert len(got) == len(rows)
    assert all(not r.kept and r.n_words == 0 for r in got if r.text in (None, "", " ", "\n\n"))
    assert quality_rules(no_docs).count() == 0
    good = "\n".join(f"Line {i} tells of something new number {i * i}." for i in range(9))
    junk = "\n".join("home | about | contact | %%% ###" for _ in range(9))
    texts = spark.createDataFrame([(good,), (good + "\nAll rights reserved",), (good[:90] + "\n" + junk,)], "text string")
    kept = [(r.kept, r.cleaned_text) for r in quality_rules(texts).collect()]
    assert kept[:2] == [(True, good), (True, good)] and not kept[2][0]


def test_urls_of_awkward_rows(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/x?y", "x://example.org", "x://badexample.org/es/", "a://b.c/p://d"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls * 2)], "page_id long, url string, host long")
    entries = spark.createDataFrame(
        [("org", "/", "allow", True), ("example.org", "/es/", "block", True), ("c", "", "block", False)],
        "host string, path string, verdict string, is_rule boolean",
    )
    got = [tuple(r)[1:] for r in filter_urls(pages, entries).orderBy("page_id").collect()]
    assert got[:7] == got[7:] == [
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "", None, "allow"),
        ("badexample.org", "/es/", "org/", "allow"),
        ("b.c", "/p://d", None, "block"),
    ]
    assert filter_urls(pages.where("false"), entries).count() == 0
    assert filter_urls(pages, entries.where("false")).where("verdict <> 'allow'").count() == 0


def test_mixing_meets_the_weights(spark, docs, no_docs):
    rows = [(i, "x" * 10, "hot" if i % 3 else "cold", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copy long")
    weights = spark.createDataFrame([("cold", 3.0), ("hot", 1.0)], "source string, weight double")
    counts = {r.source: r["count"] for r in mix_sources(df, weights).groupBy("source").count().collect()}
    assert abs(counts["cold"] - 4500) < 250 and abs(counts["hot"] - 1500) < 150
    assert mix_sources(no_docs).count() == 0
    again = [sorted(map(str, mix_sources(docs.repartition(n)).collect())) for n in (2, 5)]
    assert again[0] == again[1]
    assert source_rates(docs).where("mix_source IS NULL").count() == 1


# -- pipeline --------------------------------------------------------------------------------


def test_every_stage_follows_its_operator(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    judged = {r.doc_id: r for r in quality_rules(docs).collect()}
    kept = stages.keep_quality(docs).cache()
    assert {r.doc_id: r.text for r in kept.collect()} == {i: r.cleaned_text for i, r in judged.items() if r.kept}
    single = stages.keep_one_of_each_group(kept).cache()
    from siltbed.llm.simhash import simhash_groups

    groups = simhash_groups(kept).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    masked = stages.mask(single)
    assert masked.count() == single.count()
    assert find_pii(masked).where(F.size("base_spans") > 0).count() == 0
    for stage in (kept, single, masked, stages.mix(masked)):
        assert stage.columns == docs.columns and stage.dtypes == docs.dtypes
        assert stage.where(F.col("n_chars") != F.length("text")).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "mask_pii", "mix_sources", "pack",
    ]
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert pieces.count() > 0 and pieces.where("length <= 0 OR tier > 1024").count() == 0


def test_stages_of_awkward_rows(docs, no_docs):
    names = "node root group row text_ _node _group _row _text _cleaned mix_source mix_of mix_copy mix_key kept cleaned_text base_spans size sketch"
    wide = docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names.split()])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, wide):
            out = stage(None, table, None).cache()
            assert out.dtypes == table.dtypes and out.count() > 0
            assert stage(None, table.limit(0), None).count() == 0
        for n in names.split():
            assert out.where(F.col(n) != f"own {n}").count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(None, wide, None).where("length <= 0").count() == 0 and last(None, no_docs, None).count() == 0
    assert stages.keep_one_of_each_group(wide).dtypes == wide.dtypes


def test_large_rates_are_drawn_in_parts(spark):
    """One source of a thousandth of the text at a rate of a thousand and more."""
    rows = [(i, "x" * 10, "large" if i else "small") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("small", 1.0), ("large", 0.0)], "source string, weight double")
    out = mix_sources(df, weights)
    n = out.count()
    assert abs(n - 2000) < 6 * 2000**0.5 and out.select("mix_copy").distinct().count() == n
    assert out.agg(F.min("mix_copy"), F.max("mix_copy")).first() == (1, n)
    curve = spark.range(12).select(F.col("id").cast("string").alias("k"), poisson_cdf(F.col("id") * 0 + 16.0).alias("cdf")).cache()
    got = [r[0] for r in curve.select(poisson_draw(F.lit(2000).cast("long"), F.col("cdf"), 3, F.col("k"))).collect()]
    assert all(abs(x - 32000) < 6 * 32000**0.5 for x in got) and len(set(got)) > 6
    assert curve.select(F.size("cdf").alias("n")).first().n < 200
