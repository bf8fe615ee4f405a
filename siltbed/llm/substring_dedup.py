"""Removal of repeated passages by recompression.

Recompression rewrites a token sequence in rounds. Each round first replaces maximal runs of
one symbol by a symbol for the run, then replaces pairs whose left symbol has coin 0 and
whose right symbol has coin 1 by a symbol for the pair. A symbol's name is a digest of what
it stands for and its coin is a bit of that name, so all tasks name alike without passing a
dictionary round. Equal substrings therefore get equal symbols, except near their ends,
where the neighbours outside have a say. How far that say reaches is carried along: every
symbol has a context, the words that decide that it is there.

Each window of words is represented by one symbol of the highest level that has symbols
whose contexts lie inside the window: the one with the smallest digest, the leftmost if
that stands twice. With it goes a digest of the words of its context. Both depend on the
window's words alone, so equal windows are represented alike. Windows that share this with
no other place in the corpus cannot repeat and are done with; the few others are compared
by 128-bit digests of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.words import SLICE_BYTES, SPACES, WordBatch, combine, mix, slices

WIDTH = 20
#: Contexts grow with the rounds: after two, a symbol hangs on seven words or so, enough to be
#: rare, while a window of twenty still holds several to choose from.
ROUNDS = 2
#: An odd number, whose powers weigh the words of a range digest, and its inverse mod 2^64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
#: Stands for the number of all windows of a text.
WHOLE = -1
#: Stands for a null id, which comes before all others.
NO_ID = -(1 << 63)


@dataclass
class Level:
    """Symbols in text order: names, and the contexts [low, high) that decide them."""

    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray


def first_level(names: np.ndarray, place: np.ndarray, row: np.ndarray) -> Level:
    return Level(names, place, place + 1, row)


def _neighbours(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """The context bound of the symbol before and behind each; beyond the text at its ends."""
    edge = level.row[1:] != level.row[:-1]
    before = np.concatenate([[level.low[0] - 1], np.where(edge, level.low[1:] - 1, level.low[:-1])])
    behind = np.concatenate([np.where(edge, level.high[:-1] + 1, level.high[1:]), [level.high[-1] + 1]])
    return before, behind


def compress_runs(level: Level) -> Level:
    """Maximal runs become one symbol; that a run ends here depends on the neighbours."""
    before, behind = _neighbours(level)
    new = np.concatenate([[True], (level.name[1:] != level.name[:-1]) | (level.row[1:] != level.row[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    length = (last - first + 1).astype(np.uint64)
    name = level.name[first]
    run = length > 1
    name[run] = combine(~name[run], length[run])
    return Level(name, before[first], behind[last], level.row[first])


def compress_pairs(level: Level, number: int) -> Level:
    """Pairs of coins 0, 1 become one symbol; others depend on the neighbour they did not join."""
    before, behind = _neighbours(level)
    coin = (mix(level.name + np.uint64(number)) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(coin), dtype=bool)
    pair[:-1] = ~coin[:-1] & coin[1:] & (level.row[:-1] == level.row[1:])
    right = np.concatenate([[False], pair[:-1]])
    keep = np.flatnonzero(~right)
    joined = pair[keep]
    partner = np.minimum(keep + 1, len(coin) - 1)
    name = np.where(joined, combine(level.name[keep], level.name[partner]), level.name[keep])
    low = np.where(joined | ~coin[keep], level.low[keep], before[keep])
    high = np.where(joined, level.high[partner], np.where(coin[keep], level.high[keep], behind[keep]))
    return Level(name, low, high, level.row[keep])


ORDER = 77


def smallest(digest: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the smallest digest of each range [first, last] stands, the leftmost of equals.

    A range is covered by two blocks whose length is a power of two; block minima come from
    those of half the length.
    """
    mask = np.uint64(0xFFFFFFFF)
    least = (digest & ~mask) | np.arange(len(digest), dtype=np.uint64)
    out = np.zeros(len(first), dtype=np.uint64)
    n = last - first + 1
    size = 1
    while len(n) and size <= n.max():
        now = (n >= size) & (n < 2 * size)
        out[now] = np.minimum(least[first[now]], least[last[now] - size + 1])
        if size < len(least):
            least[:-size] = np.minimum(least[:-size], least[size:])
        size *= 2
    return (out & mask).astype(np.int64)


class RangeDigests:
    """Digests of any ranges of a sequence, from sums of its weighed members."""

    def __init__(self, names: np.ndarray):
        weights = np.cumprod(np.full(len(names) + 1, BASE, dtype=np.uint64))
        self.unweigh = np.cumprod(np.full(len(names) + 1, UNBASE, dtype=np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * weights[:-1])])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.unweigh[first])


def window_symbols(names: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """The windows of a batch grouped by the symbol that represents them.

    ``names`` holds the word digests of texts cut by ``offsets``. Returns for each group of
    neighbouring windows: symbol, text, first window, number of windows.
    """
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    # Two free places between texts keep contexts of different texts apart.
    place = np.arange(len(names)) + 2 * row
    windows = place[np.arange(len(names)) + width <= offsets[1:][row]]
    symbol = np.zeros(len(windows), dtype=np.uint64)
    which = np.zeros(len(windows), dtype=np.int64)
    open_ = np.arange(len(windows))
    if not len(windows):
        empty = np.zeros(0, dtype=np.int64)
        return symbol, empty, empty, empty
    levels = [first_level(names, place, row)]
    for number in range(ROUNDS):
        levels.append(compress_pairs(compress_runs(levels[-1]), number))
    ranges = RangeDigests(names)
    base = 0
    for height in range(len(levels) - 1, -1, -1):
        level = levels[height]
        w = windows[open_]
        first = np.minimum(np.searchsorted(level.low, w), len(level.low) - 1)
        last = np.searchsorted(level.high, w + width, side="right") - 1
        inside = (level.low[first] >= w) & (last >= first)
        best = smallest(mix(level.name + np.uint64(ORDER)), first[inside], last[inside])
        chosen = np.unique(best)
        shift = 2 * level.row[chosen]
        context = ranges.of(level.low[chosen] - shift, level.high[chosen] - shift)
        represented = combine(level.name[chosen] + np.uint64(height), context)
        done = open_[inside]
        symbol[done] = represented[np.searchsorted(chosen, best)]
        which[done] = base + best
        base += len(level.low)
        open_ = open_[~inside]
        if not len(open_):
            break
    owner = row[np.searchsorted(place, windows)]
    start = windows - 2 * owner - offsets[:-1][owner]
    fresh = np.concatenate([[True], (which[1:] != which[:-1]) | (np.diff(windows) != 1)])
    first = np.flatnonzero(fresh)
    return symbol[first], owner[first], start[first], np.diff(np.append(first, len(windows)))


def word_digests(words: WordBatch) -> np.ndarray:
    """128-bit digests of a batch's words as two 64-bit columns."""
    digests = b"".join([xxhash.xxh3_128_digest(w) for w in words.distinct.to_pylist()])
    table = np.frombuffer(digests, dtype="<u8").reshape(-1, 2).astype(np.uint64)
    return table[words.codes] if len(words.codes) else np.zeros((0, 2), np.uint64)


def window_digests(names: np.ndarray, width: int) -> np.ndarray:
    """Digests of the windows that start at each word; the last ``width - 1`` are no windows.

    Windows of twice the words are made from two halves, and the width from its powers of two.
    """
    total, covered = None, 0
    power, size = names.copy(), 1
    while True:
        if width & size:
            total = power if total is None else combine(total, _ahead(power, covered))
            covered += size
        if covered == width:
            return total
        power = combine(power, _ahead(power, size))
        size *= 2


def _ahead(values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(values)
    if n < len(values):
        out[: len(values) - n] = values[n:]
    return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [first, first + count), one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


ANCHORS = "name long, settled boolean, k long, h long, ord int, start int, n int"
WINDOWS = "wa long, wb long, settled boolean, k long, h long, ord int, start int, n int"
REMOVED = "k long, h long, ord int, start int, n int"
#: What tells a row from all others: its id, a digest of its text, and a number among equal rows.
ROW = ["k", "h", "ord"]


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(c).cast(kinds[t]) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def _row_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(c)) for c in ROW)


def _find_anchors(width: int, most: int):
    """Symbols of the windows. Of those that repeat within a slice one marker goes on.

    So a name that a third of all texts share reaches its task once per slice. Rows it stood
    for are settled: they go on under numbers of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most=most):
            words = WordBatch(batch.column("text"))
            symbol, row, start, n = window_symbols(word_digests(words)[:, 0], words.offsets, width)
            k, h, ord_ = _row_keys(batch)
            found, which, count = np.unique(symbol, return_inverse=True, return_counts=True)
            settled = (count > 1)[which]
            at = (h[row].astype(np.uint64) + mix(start.astype(np.uint64))) if len(row) else symbol
            name = np.where(settled, mix(at), symbol)
            yield _batch(ANCHORS, name.view(np.int64), settled, k[row], h[row], ord_[row], start, n)
            marks = found[count > 1]
            none = np.zeros(len(marks), np.int64)
            yield _batch(ANCHORS, marks.view(np.int64), none.astype(bool), none, none, none, none, none)

    return run


def _repeated_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by settled and name, those that are settled or whose name another row has too."""
    held: pa.RecordBatch | None = None
    seen = False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            name, settled = (np.concatenate([np.asarray(held.column(i)), np.asarray(batch.column(i))[:1]]) for i in (0, 1))
            same = (name[1:] == name[:-1]) & (settled[1:] == settled[:-1])
            yield _kept(held, same | np.concatenate([[seen], same[:-1]]))
            seen = bool(same[-1])
        held = batch
    if held is not None:
        name, settled = (np.asarray(held.column(i)) for i in (0, 1))
        same = np.append((name[1:] == name[:-1]) & (settled[1:] == settled[:-1]), False)
        yield _kept(held, same | np.concatenate([[seen], same[:-1]]))


def _kept(batch: pa.RecordBatch, repeated: np.ndarray) -> pa.RecordBatch:
    """The rows to go on, without the markers, which span no windows."""
    keep = (repeated | np.asarray(batch.column("settled"))) & (np.asarray(batch.column("n")) > 0)
    return batch.filter(pa.array(keep)).select(["k", "h", "ord", "start", "n"])


def _of_row(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The listed spans that belong to each row of a batch: row, start, number."""
    lists = batch.column(column)
    parents = np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    spans = lists.flatten()
    own = np.asarray(spans.field("ord")) == np.asarray(batch.column("ord"))[parents]
    start, n = (np.asarray(spans.field(f), dtype=np.int64)[own] for f in ("start", "n"))
    return parents[own], start, n


def _digest_windows(width: int, most: int):
    """Digests of the windows in question; those that repeat within the batch are settled here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most=most):
            batch = batch.take(pc.sort_indices(pa.Table.from_batches([batch]), [(c, "ascending") for c in ROW]))
            words = WordBatch(batch.column("text"))
            names = word_digests(words)
            row, start, n = _of_row(batch, "spans")
            place = np.sort(_ranges(words.offsets[row] + start, n))
            a, b = (window_digests(names[:, i].copy(), width)[place] for i in (0, 1))
            order = np.argsort(a, kind="stable")
            fresh = np.concatenate([[True], a[order][1:] != a[order][:-1]])[: len(order)]
            head = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(order) else order
            later = np.zeros(len(place), dtype=bool)
            later[order] = ~fresh & (b[order] == b[head])
            owner = np.searchsorted(words.offsets, place, side="right") - 1
            at = place - words.offsets[owner]
            k, h, ord_ = _row_keys(batch)
            mine = ~later
            yield _batch(
                WINDOWS, a[mine].view(np.int64), b[mine].view(np.int64), np.zeros(mine.sum(), bool), k[owner[mine]],
                h[owner[mine]], ord_[owner[mine]], at[mine], np.ones(mine.sum(), np.int64),
            )
            # Neighbouring windows are one span.
            gone = place[later]
            first = np.flatnonzero(np.concatenate([[True], np.diff(gone) != 1])[: len(gone)])
            o, s = owner[later][first], at[later][first]
            length = np.diff(np.append(first, len(gone)))
            yield _batch(
                WINDOWS, mix(h[o].astype(np.uint64) + s.astype(np.uint64)).view(np.int64), np.zeros(len(o), np.int64),
                np.ones(len(o), bool), k[o], h[o], ord_[o], s, length,
            )

    return run


def _later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by settled, digest and position: settled spans, and all but the first of equals."""
    before = np.zeros((0, 3), dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        settled = np.asarray(batch.column("settled"))
        key = np.stack([np.asarray(batch.column("wa")), np.asarray(batch.column("wb")), settled.astype(np.int64)], axis=1)
        both = np.concatenate([before, key])
        same = np.concatenate([[False], (both[1:] == both[:-1]).all(axis=1)])[len(before) :]
        rows = batch.filter(pa.array(settled | same))
        before = key[-1:]
        yield rows.select(["k", "h", "ord", "start", "n"])


def _cut_texts(width: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most=most):
            words = WordBatch(batch.column("text"))
            counts = words.counts()
            row, start, n = _of_row(batch, "spans")
            n = np.where(n == WHOLE, np.maximum(counts[row] - width + 1, 0), n)
            start, row, n = start[n > 0], row[n > 0], n[n > 0]
            # Words under a span of windows: marks at both ends, summed up.
            first = words.offsets[row] + start
            marks = np.zeros(len(words.codes) + 1, dtype=np.int64)
            np.add.at(marks, first, 1)
            np.add.at(marks, first + n + width - 1, -1)
            kept = np.cumsum(marks)[:-1] == 0
            bounds = np.concatenate([[0], np.cumsum(kept)])[words.offsets]
            tokens = words.distinct.take(pa.array(words.codes[kept]))
            lists = pa.LargeListArray.from_arrays(pa.array(bounds), tokens)
            texts = pc.cast(pc.binary_join(lists, pa.scalar(" ", pa.large_string())), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(counts), pa.array(counts - np.diff(bounds)), texts],
                names=["k", "n_words", "n_removed", "kept_text"],
            )

    return run


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, id: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(id, n_words, n_removed, kept_text): every text without the passages found earlier.

    A window of ``width`` words repeats if its words also start earlier: in a document of a
    smaller id, or in the same one. All words under repeating windows go; the first
    occurrence stays. Kept words are joined by single spaces. Ids are integers. Rows with
    equal ids are documents of their own, in the order of a digest of their texts; a null id
    comes first and a null text has no words. Texts below the width keep all words. Further
    columns are not read. An empty table stays empty.

    Texts are dealt once, by id and digest so that rows that share an id are spread, and that
    exchange serves all passes over them. Copies of whole documents are settled first. Other
    exchanges carry symbols of about every sixth word, then the windows in question, of which
    each slice of ``slice_bytes`` sends an equal one only once.
    """
    key = F.coalesce(F.col(id).cast("long"), F.lit(NO_ID))
    dealt = docs.select(key.alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text")).repartition("k", "h")
    # Equal rows already lie together; the number tells them apart.
    dealt = dealt.withColumn("ord", F.row_number().over(Window.partitionBy("k", "h").orderBy("text")))
    copies = later_copies(dealt)
    none = F.array().cast("array<struct<ord:int,start:int,n:int>>")
    known = F.coalesce("spans", none)
    fresh = dealt.join(_spans(copies), ["k", "h"], "left").where(~F.exists(known, lambda x: x["ord"] == F.col("ord")))
    anchors = fresh.select(*ROW, "text").mapInArrow(_find_anchors(width, slice_bytes), ANCHORS)
    shared = anchors.repartition("name").sortWithinPartitions("settled", "name").mapInArrow(_repeated_names, REMOVED)
    asked = dealt.join(_spans(shared), ["k", "h"]).select(*ROW, "text", "spans")
    windows = asked.mapInArrow(_digest_windows(width, slice_bytes), WINDOWS)
    later = (
        windows.repartition("wa", "wb")
        .sortWithinPartitions("settled", "wa", "wb", *ROW, "start")
        .mapInArrow(_later_windows, REMOVED)
    )
    gone = _spans(later.union(copies))
    cut = dealt.join(gone, ["k", "h"], "left").select(*ROW, "text", known.alias("spans"))
    done = cut.mapInArrow(_cut_texts(width, slice_bytes), "k long, n_words long, n_removed long, kept_text string")
    kind = docs.schema[id].dataType
    return done.select(F.nullif(F.col("k"), F.lit(NO_ID)).cast(kind).alias(id), "n_words", "n_removed", "kept_text")


def later_copies(dealt: DataFrame) -> DataFrame:
    """Documents whose whole word sequence an earlier one has, with all windows as their span.

    They are settled here, by a digest of their words, so that neither they nor, on their
    account, the originals have single windows compared.
    """
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), f"{SPACES}+", " "))
    marked = dealt.select(F.md5(joined).alias("digest"), *ROW)
    at = F.struct(*ROW)
    firsts = marked.groupBy("digest").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = marked.join(firsts, "digest").where(at != F.col("first"))
    return later.select(*ROW, F.lit(0).alias("start"), F.lit(WHOLE).alias("n"))


def _spans(rows: DataFrame) -> DataFrame:
    """Spans of windows as one list per id and text, as long as a document at most."""
    return rows.groupBy("k", "h").agg(F.collect_list(F.struct("ord", "start", "n")).alias("spans"))
