"""The near-duplicate stage against brute-force similarity of five-word shingles."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import near_dedup
from siltbed.llm.near_dedup import with_group

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None) -> frozenset:
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def near(a: frozenset, b: frozenset) -> bool:
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute_groups(texts) -> list[int]:
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if near(sets[i], sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def changed(rng: random.Random, words: list[str], n: int) -> list[str]:
    out = words[:]
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


def edited_texts() -> list[str]:
    """Pairs around and above the limit, chains of edits, and a template with other fillings."""
    rng = random.Random(11)
    texts = []
    for k in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 240))]
        texts.append(" ".join(words))
        for _ in range(2):
            words = changed(rng, words, 1 + k % 6)
            texts.append(" ".join(words))
    template = [f"t{i}" for i in range(150)]
    texts += [" ".join(changed(rng, template, 4)) for _ in range(40)]
    texts += ["", None, " \n", "one two", "One TWO", "two one", "a b c d e", "A b c d E", "a b c d f"]
    return texts


def test_groups_equal_brute_force(spark):
    texts = edited_texts()
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 0 < len(sets[i] & sets[j]) < len(sets[i] | sets[j])]
    alike = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in pairs]
    assert sum(0.8 <= x < 0.95 for x in alike) > 50 and sum(0.6 < x < 0.8 for x in alike) > 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.row.doc_id: r.group for r in with_group(docs).collect()}
    want = brute_groups(texts)
    first = {}
    for i, group in enumerate(want):
        first.setdefault(got[i], i)
    assert [first[got[i]] for i in range(len(texts))] == want
    kept = corpus_pipeline.STAGES[1][1](spark, docs, None).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want))


def marks_of(spark, texts):
    marks = near_dedup.marked(spark.createDataFrame([(t,) for t in texts], "text string"))
    return marks.select(F.col("row.text").alias("text"), *[c for c in marks.columns if c not in ("row", "text")])


def groups_of(marks) -> dict:
    roots = {r.node: r.root for r in near_dedup.near_links(marks).collect()}
    return {r.text: roots.get(r.node, r.node) for r in marks.select("text", "node").collect()}


def test_simhash_proposes_pairs_that_share_no_band(spark):
    rng = random.Random(3)
    long, other = ([f"w{rng.randrange(9000)}" for _ in range(600)] for _ in range(2))
    texts = [" ".join(long), " ".join(long) + " end", " ".join(other), " ".join(other) + " end"]
    marks = marks_of(spark, texts)
    found = groups_of(marks.withColumn("bands", F.array("node")))
    assert found[texts[0]] == found[texts[1]] != found[texts[2]] == found[texts[3]]


def test_simhash_proposals_are_settled_on_the_sets(spark):
    texts = [t for t in edited_texts()[:60] if shingles(t)]
    marks = marks_of(spark, texts)
    found = groups_of(marks.withColumn("fingerprint", F.lit(0).cast("long")))
    want = brute_groups(texts)
    first = {}
    for i, group in enumerate(want):
        first.setdefault(found[texts[i]], i)
    assert [first[found[t]] for t in texts] == want
