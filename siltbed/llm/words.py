"""Words, lines and the two forms in which the operators read them.

A word is a run of characters other than ASCII white space (space, tab to carriage
return). ``words`` gives them as a column; ``WordBatch`` gives the words of an Arrow batch
as codes into its distinct words, so that per-word work is done once per distinct word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(text_or_empty(text), f"{SPACES}+", -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Bytes of text that are worked on at once. Arrays per word take some ten times that.
SLICE_BYTES = 2 << 20


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Bytes of each text; none for null."""
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)


def slices(
    batches: Iterator[pa.RecordBatch], at: int | str, rows: int = 4096, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of column ``at`` take at most ``most`` bytes, or are one row.

    Memory follows the bytes of the texts, not their number: a slice of many short texts and
    one of a single long text need about the same.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(text_bytes(batch.column(at)))
        first = 0
        while first < batch.num_rows:
            taken = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, taken + most, side="right"))
            last = min(max(last, first + 1), first + rows, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


class WordBatch:
    """Words of a batch of texts: ``codes`` into ``distinct``, cut by ``offsets``."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        pieces = pc.split_pattern_regex(texts, f"{SPACES}+")
        flat = pieces.flatten()
        ends = np.asarray(pieces.offsets, dtype=np.int64)
        ends = ends - ends[0]
        coded = flat.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        codes = np.asarray(coded.indices, dtype=np.int64)
        real = np.asarray(pc.not_equal(coded.dictionary, ""), dtype=bool)[codes] if len(codes) else np.zeros(0, bool)
        kept = np.concatenate([[0], np.cumsum(real)])
        self.offsets = kept[ends].astype(np.int64)
        self.codes = codes[real]
        self.distinct: pa.Array = coded.dictionary

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit digest of an ordered pair of digests."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right + np.uint64(0x632BE59BD9B4E019)))
