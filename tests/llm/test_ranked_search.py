"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siltbed.llm.ranked_search import Best, Shard, blocks, ranked_search, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, most=50):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    frequency = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, found = set(plain_terms(text)), []
        for (i, c), n in zip(counts, lengths):
            score = 0
            for t in asked & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * n * n_docs) // n_terms)))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:most], 1)]
    return out


def same(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search(d.repartition(3), q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_search(docs, items, **options), key=repr)


def prose(rng, n):
    return " ".join(f"W{min(rng.randrange(1, 60), rng.randrange(1, 400))}" for _ in range(n))


def test_equals_plain_scoring(spark):
    rng = random.Random(2)
    docs = [(i * 3 % 701, prose(rng, rng.randrange(1, 80))) for i in range(701)]
    items = [(i, prose(rng, rng.randrange(1, 30))) for i in range(25)]
    same(spark, docs, items)
    same(spark, docs, items, most=3)


def test_many_copies_and_several_shards(spark):
    rng = random.Random(4)
    copies = [prose(rng, 12) for _ in range(3)]
    docs = [(i, rng.choice(copies) if i % 3 else prose(rng, 5)) for i in rng.sample(range(20_000), 9000)]
    same(spark, docs, [(7, copies[0]), (8, copies[1] + " " + copies[2]), (9, prose(rng, 9))], most=20)


def test_awkward_rows(spark, rows):
    docs = [(r[0], r[1]) for r in rows] + [(None, "word w1 w2"), (None, "w1"), (5, "w1"), (5, "w1"), (6, "Größe\x00É é_é~é")]
    items = [(1, "w1 w2 W1 w300"), (1, "w1"), (None, "größe É"), (2, None), (3, ""), (4, " .,; "), (5, "nowhere"), (6, "é word")]
    items.append((8, " ".join(f"w{i}" for i in range(300)) * 5))
    same(spark, docs, items)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 2, 3, "t")], "doc_id int, text string, n int, score int, terms string")
    items = spark.createDataFrame([(1, "a", 5, 6)], "item_id long, text string, rank int, number int")
    assert [r["doc_id"] for r in ranked_search(docs, items).collect()] == [1]
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    assert ranked_search(docs.limit(0), items.limit(0)).dtypes == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "int"), ("score", "bigint"),
    ]


def test_queries_come_in_bounded_blocks(spark):
    items = spark.range(2500).selectExpr("id", "cast(id as string)")
    sizes = [len(b) for b in blocks(items)]
    assert sum(sizes) == 2500 and max(sizes) <= 1000


@pytest.mark.parametrize("wave", [1, 7, 256])
def test_intervals_are_dropped(wave):
    rng = np.random.default_rng(8)
    postings = np.unique(rng.integers(0, 2000 * 30, 20_000))
    row, term = postings // 30, postings % 30
    impact = rng.integers(1, 1 << 30, len(row)) ** 2 >> 30
    shard = Shard(row, term, impact, 2000, 30)
    ids, terms = np.arange(2000) * 2, np.arange(5)
    best = Best(10)
    scored = search(shard, ids, terms, best, wave)
    whole = np.bincount(row[term < 5], impact[term < 5], 2000).astype(np.int64)
    order = np.lexsort((ids, -whole))[:10]
    assert best.score.tolist() == whole[order].tolist() and best.id.tolist() == ids[order].tolist()
    assert scored < 1000


def test_terms():
    assert terms_of("Ab-ab ÉÉ a1_b\x7fc") == ["ab", "ÉÉ", "a1", "b", "c"]
    assert terms_of(None) == []
