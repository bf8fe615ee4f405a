"""Ranked lexical search with range-maximum tables over posting lists.

Documents become a forward index of the asked terms, written once. Tasks invert shards of
it: a posting list per term in document order with the impact of each posting, and over
every list a sparse table of range maxima. For a query the best score within an interval of
documents is at most the sum of its terms' maxima there. Intervals wait best first; the best
is split at the document where its largest maximum stands, that document is scored, and the
halves wait with bounds of their own. Intervals whose bound is beaten by the documents found
are dropped, so most documents are never scored. Intervals are handled some hundred at a
time, by array operations.

Queries come in blocks of bounded size, which tasks get with the work; documents are never
joined with queries. Each task sends its best documents only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.simhash import lower_ascii
from siltbed.llm.words import slices
from siltbed.sources.session import staged

#: What stands between terms.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
MOST = 50
#: Queries of a block, and characters of their texts together.
BLOCK_ITEMS, BLOCK_CHARS = 1000, 4 << 20
#: Documents of a shard whose lists are in memory at once, and bits that number them.
SHARD, SHARD_BITS = 2048, 11
#: Intervals that are split at once.
WAVE = 256
#: Cells of the table that tells where each document's place in each list is.
CELLS = 1 << 22
LAST = (1 << 63) - 1


def terms_of(text: str | None) -> list[str]:
    """Distinct terms of a query in order."""
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return list(dict.fromkeys(t for t in re.split(BETWEEN, low) if t))


class Forward:
    """Counts of the asked terms in each text of a batch."""

    def __init__(self, texts: pa.Array, asked: pa.Array):
        low = pc.cast(lower_ascii(texts), pa.large_string())
        pieces = pc.split_pattern_regex(low, BETWEEN)
        flat = pieces.flatten()
        ends = np.asarray(pieces.offsets, dtype=np.int64)
        real = np.concatenate([[0], np.cumsum(np.asarray(pc.not_equal(flat, ""), dtype=bool))])
        bounds = ends - ends[0]
        self.n = np.diff(real[bounds])
        term = np.asarray(pc.fill_null(pc.index_in(flat, value_set=asked), -1), dtype=np.int64)
        row = np.repeat(np.arange(len(self.n)), np.diff(bounds))
        hit = term >= 0
        keys, self.tf = np.unique(row[hit] * len(asked) + term[hit], return_counts=True)
        self.term = keys % max(len(asked), 1)
        self.bounds = np.searchsorted(keys, np.arange(len(self.n) + 1) * len(asked))


def forward_index(docs: DataFrame, asked: list[str], id: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: its length and the asked terms in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(asked, pa.large_string())
        for part in slices(batches, 1):
            found = Forward(part.column(1), values)
            offsets = pa.array(found.bounds, pa.int32())
            rows = pa.RecordBatch.from_arrays(
                [
                    pc.cast(part.column(0), pa.int64()),
                    pa.array(found.n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found.term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(found.tf, pa.int32())),
                ],
                names=["id", "n", "terms", "tfs"],
            )
            yield rows.filter(pa.array(found.n > 0))

    return docs.select(id, text).mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequency], dtype=np.int64)


class Shard:
    """Posting lists of some documents, which are in ascending order of their ids."""

    def __init__(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, vocabulary: int):
        order = np.lexsort((row, term))
        self.docs, self.row, self.impact = docs, row[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(vocabulary + 1))
        mask = (1 << SHARD_BITS) - 1
        # A posting's impact with its document behind it: maxima tell both.
        level = (self.impact << SHARD_BITS) | (mask - self.row)
        longest = int(np.diff(self.starts).max(initial=1))
        levels, size = [level], 1
        while 2 * size <= longest:
            # Ranges that reach into the next list are never asked for.
            level = level.copy()
            np.maximum(level[:-size], level[size:], out=level[:-size])
            levels.append(level)
            size *= 2
        self.table = np.stack(levels)
        self.log = np.zeros(longest + 2, np.int64)
        for i in range(2, longest + 2):
            self.log[i] = self.log[i // 2] + 1

    def places(self, terms: np.ndarray, low: int, high: int) -> np.ndarray:
        """(term, document - low): how far the term's list is at the document; one more column at the end."""
        begin = np.array([np.searchsorted(self.row[s:e], [low, high]) + s for s, e in zip(self.starts[terms], self.starts[terms + 1])])
        out = np.zeros((len(terms), high - low + 1), np.int32)
        for i, (s, e) in enumerate(begin.tolist()):
            out[i, self.row[s:e] - low + 1] = 1
        np.cumsum(out, axis=1, out=out)
        out += begin[:, :1].astype(np.int32)
        return out

    def bound(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ranges [first, end) of the lists, (terms, intervals): summed maxima, and where the largest stands."""
        n = end - first
        some = n > 0
        h = self.log[n]
        best = np.maximum(self.table[h, np.where(some, first, 0)], self.table[h, np.where(some, end - (1 << h), 0)])
        best *= some
        mask = (1 << SHARD_BITS) - 1
        return (best >> SHARD_BITS).sum(axis=0), mask - (best.max(axis=0) & mask)


class Best:
    """The best documents of one query so far: score, id and where they came from."""

    def __init__(self, most: int):
        self.most = most
        self.score, self.id, self.origin = (np.zeros(0, np.int64) for _ in range(3))

    def take(self, score: np.ndarray, id: np.ndarray, origin: np.ndarray) -> None:
        score, id = np.concatenate([self.score, score]), np.concatenate([self.id, id])
        origin = np.concatenate([self.origin, origin])
        order = np.lexsort((id, -score))[: self.most]
        self.score, self.id, self.origin = score[order], id[order], origin[order]

    def open(self, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a document with such a bound and no smaller id can still get in."""
        if len(self.score) < self.most:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (least_id < self.id[-1]))


def search(shard: Shard, ids: np.ndarray, terms: np.ndarray, best: Best, wave: int = WAVE) -> int:
    """Brings the best documents of a shard into ``best``; returns how many were scored."""
    terms = terms[shard.starts[terms + 1] > shard.starts[terms]]
    if not len(terms):
        return 0
    scored, step = 0, max(1, min(shard.docs, CELLS // len(terms)))
    for begin in range(0, shard.docs, step):
        stop = min(begin + step, shard.docs)
        places = shard.places(terms, begin, stop)

        def waiting(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            bound, split = shard.bound(places[:, low - begin], places[:, high - begin])
            here = best.open(bound, ids[np.minimum(low, len(ids) - 1)])
            return np.stack([low, high, bound, split])[:, here]

        pool = waiting(np.array([begin]), np.array([stop]))
        while pool.shape[1]:
            if pool.shape[1] > wave:
                order = np.argpartition(-pool[2], wave)
                now, pool = pool[:, order[:wave]], pool[:, order[wave:]]
            else:
                now, pool = pool, pool[:, :0]
            low, high, _, split = now
            at = places[:, split - begin]
            there = places[:, split - begin + 1] > at
            score = (shard.impact[np.where(there, at, 0)] * there).sum(axis=0)
            scored += len(split)
            good = best.open(score, ids[split])
            if good.any():
                best.take(score[good], ids[split[good]], split[good])
                pool = pool[:, best.open(pool[2], ids[pool[0]])]
            lows, highs = np.concatenate([low, split + 1]), np.concatenate([split, high])
            some = lows < highs
            if some.any():
                pool = np.concatenate([pool, waiting(lows[some], highs[some])], axis=1)
    return scored


def _best_of_tasks(index: DataFrame, queries: list[np.ndarray], w: np.ndarray, n_docs: int, n_terms: int, most: int) -> DataFrame:
    """(number, id, score): for each query the best documents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(most) for _ in queries]
        for batch in batches:
            for first in range(0, batch.num_rows, SHARD):
                part = batch.slice(first, SHARD)
                own = part.column("id")
                key = np.asarray(pc.fill_null(own, LAST), dtype=np.int64)
                order = np.argsort(key, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                length, which = np.unique(np.asarray(part.column("n"), dtype=np.int64), return_inverse=True)
                m = np.array([100 - 50 + 50 * int(x) * n_docs // n_terms for x in length], dtype=np.int64)[which]
                parents = np.asarray(pc.list_parent_indices(part.column("terms")), dtype=np.int64)
                term = np.asarray(part.column("terms").flatten(), dtype=np.int64)
                tf = np.asarray(part.column("tfs").flatten(), dtype=np.int64)
                impact = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[parents]))
                some = impact > 0
                shard = Shard(place[parents[some]], term[some], impact[some], part.num_rows, len(w))
                if not len(shard.row):
                    continue
                numbers, rows, scores = [], [], []
                for number, terms in enumerate(queries):
                    mine = best[number]
                    mine.origin = np.full(len(mine.id), -1)
                    search(shard, key[order], terms, mine)
                    new = mine.origin >= 0
                    numbers.append(np.full(new.sum(), number))
                    rows.append(order[mine.origin[new]])
                    scores.append(mine.score[new])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(numbers), pa.int32()),
                        own.take(pa.array(np.concatenate(rows))),
                        pa.array(np.concatenate(scores), pa.int64()),
                    ],
                    names=["number", "id", "score"],
                )

    return index.mapInArrow(run, "number int, id long, score long")


def blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Rows of (item, text) in blocks that a driver and a task can hold."""
    held, chars = [], 0
    for row in items.toLocalIterator():
        if held and (len(held) >= BLOCK_ITEMS or chars + len(row[1]) > BLOCK_CHARS):
            yield held
            held, chars = [], 0
        held.append(tuple(row))
        chars += len(row[1])
    yield held


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    most: int = MOST,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    query: str = "text",
) -> DataFrame:
    """(item, rank, id, score): for each item the ``most`` documents of the highest scores above 0.

    A document's score sums over the item's distinct terms the weight of the term times a
    saturating function of its count and of the document's length, in whole numbers. Equal
    scores are in order of ids, null ids last. Ids of documents are integers. Null and empty
    texts have no terms: such documents are never found and items without terms find nothing.
    Rows of documents that repeat are documents of their own, and so are rows of items: where
    item ids repeat, each row has its ranks. Further columns are not read. An empty table on
    either side gives no rows.
    """
    asked = items.select(F.col(item).alias("item"), F.coalesce(F.col(query), F.lit("")).alias("text"))
    kind = items.schema[item].dataType.simpleString()
    found = None
    for block in blocks(asked):
        part = _search_block(docs, block, kind, most, id, text)
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("item").alias(item), "rank", F.col("id").cast(docs.schema[id].dataType).alias(id), "score")


def _search_block(docs: DataFrame, block: list[tuple], kind: str, most: int, id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    terms = [terms_of(t) for _, t in block]
    vocabulary = list(dict.fromkeys(t for each in terms for t in each))
    number = {t: i for i, t in enumerate(vocabulary)}
    queries = [np.array([number[t] for t in each], dtype=np.int64) for each in terms]
    index = staged(forward_index(docs, vocabulary, id, text))
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequency = np.zeros(len(vocabulary), np.int64)
    for t, df in counted.collect():  # No more rows than the block has terms.
        frequency[t] = df
    best = _best_of_tasks(index, queries, weights(n_docs, frequency), n_docs, n_terms or 1, most)
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    named = spark.createDataFrame([(i, it) for i, (it, _) in enumerate(block)], f"number int, item {kind}")
    return ranked.join(named, "number").select("item", "rank", "id", "score")
