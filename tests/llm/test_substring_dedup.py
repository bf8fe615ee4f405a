"""Repeated passages against a plain Python search over all windows."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltbed.llm.substring_dedup import _find_anchors, remove_repeats, window_digests, window_symbols

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def digest(text):
    """What orders rows of one id."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (h >> 63 << 64)


def plain(rows, width=20):
    """(id, n_words, n_removed, kept text) from (id, text) in any order."""
    docs = sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    seen, out = set(), []
    for doc_id, text in docs:
        w = WORDS.findall(text or "")
        gone = set()
        for s in range(len(w) - width + 1):
            window = tuple(w[s : s + width])
            if window in seen:
                gone.update(range(s, s + width))
            seen.add(window)
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def compare(df, rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(map(tuple, df.collect()), key=order) == sorted(plain(rows), key=order)


def test_equals_plain_python(docs, rows):
    compare(remove_repeats(docs), [r[:2] for r in rows])


@pytest.mark.parametrize("seed", range(4))
def test_passages_of_all_kinds(spark, seed):
    """Passages, copies, runs of one word and small vocabularies, over slices of some rows, one row and all."""
    rng = random.Random(seed)
    vocabulary = ["a"] * seed + [f"w{i}" for i in range(3 if seed == 3 else 60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 90))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((i if i % 9 else rng.randrange(60, 64), " ".join(words)))
    rows += [(None, rows[5][1]), (None, None), (200, None), (201, "a " * 90), (202, "a " * 95)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most in (2000, 1, 1 << 21)[: 2 if seed else 3]:
        compare(remove_repeats(df, slice_bytes=most), rows)


def test_many_rows_share_an_id_and_a_text(spark):
    rng = random.Random(9)
    common = [rng.choice("abcdefg") + str(rng.randrange(50)) for _ in range(60)]
    rows = [(0 if i % 3 else None, " ".join([f"x{rng.randrange(90)}" for _ in range(20)] + common)) for i in range(120)]
    rows += [(7, " ".join(common))] * 40
    compare(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), slice_bytes=3000), rows)


def test_a_name_leaves_a_slice_once():
    """However many texts of a slice share a passage, each of its names goes on as one marker."""
    import pyarrow as pa

    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"a{i} b{i} {passage} c{i}" for i in range(200)]
    numbers = np.arange(200)
    batch = pa.RecordBatch.from_pydict({"k": numbers, "h": numbers, "ord": numbers, "text": texts})
    rows = pa.Table.from_batches(list(_find_anchors(20, 1 << 21)(iter([batch])))).to_pandas()
    going = rows[~rows.settled]
    assert going.name.value_counts().max() == 1 and len(going[going.n == 0]) < 30
    assert rows[rows.settled].groupby("k").n.sum().min() >= 30


def test_given_table(spark):
    """A whole given table."""
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall()
    compare(remove_repeats(spark.read.parquet(path)), rows)


def test_clashing_columns_and_nothing(spark, no_docs):
    assert remove_repeats(no_docs).count() == 0
    df = spark.createDataFrame([(1, "x y", 3, "n")], "doc_id int, text string, k int, ord string")
    assert remove_repeats(df).collect() == [(1, 2, 0, "x y")]
    assert remove_repeats(df).schema["doc_id"].dataType.simpleString() == "int"


def test_equal_windows_have_equal_symbols():
    """What makes the search exact: a window's symbol follows from its words."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 4, rng.integers(0, 300)).astype(np.uint64) for _ in range(60)]
    texts += [np.ones(80, np.uint64), np.tile(np.array([1, 2], np.uint64), 50)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    symbol, row, start, n = window_symbols(np.concatenate(texts), offsets, 6)
    found = defaultdict(set)
    windows = 0
    for s, r, w, c in zip(symbol.tolist(), row.tolist(), start.tolist(), n.tolist()):
        for i in range(w, w + c):
            found[tuple(texts[r][i : i + 6].tolist())].add(s)
            windows += 1
    assert windows == sum(max(0, len(t) - 5) for t in texts)
    assert all(len(s) == 1 for s in found.values())


def test_symbols_are_sparse_in_varied_text():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    symbol, *_ = window_symbols(names, np.array([0, len(names)]), 20)
    assert len(symbol) < len(names) / 4


@pytest.mark.parametrize("width", [1, 2, 5, 20, 33])
def test_digests_cover_the_window(width):
    rng = np.random.default_rng(width)
    names = rng.integers(0, 3, 200, dtype=np.uint64)
    digests = window_digests(names, width)[: len(names) - width + 1]
    windows = [tuple(names[i : i + width].tolist()) for i in range(len(digests))]
    assert len(set(zip(windows, digests.tolist()))) == len(set(windows)) == len(set(digests.tolist()))


def test_texts_are_shuffled_once(spark):
    plan = remove_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan.select(F.sha2("kept_text", 256)).collect()
    text = plan._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
