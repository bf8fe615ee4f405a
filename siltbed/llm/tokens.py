"""Token ids of whole batches of texts.

A byte-level tokenizer cuts a text before a single space that stands between two other
characters, so the ids of a text are those of its pieces " word" in order. Each distinct
piece of a batch is encoded once and the ids are put together by array operations.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
END_ID = 0
#: How byte-level vocabularies write a space.
SPACE_BYTE = "\u0120"
#: Words whose ids a process remembers before it starts anew; some 50 bytes each.
MOST_KNOWN = 1_500_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Known:
    """Ids of words met so far, found by a 128-bit digest of the word."""

    def __init__(self):
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, size and whether it is missing, for each key."""
        begins, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(self.key):
            return begins, sizes, np.ones(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.key, keys[:, 0]), len(self.key) - 1)
        found = (self.key[at] == keys[:, 0]) & (self.check[at] == keys[:, 1])
        begins[found], sizes[found] = self.begin[at[found]], self.size[at[found]]
        return begins, sizes, ~found

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Take in new words; returns where their ids begin."""
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        key = np.concatenate([self.key, keys[:, 0]])
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.check = np.concatenate([self.check, keys[:, 1]])[order]
        self.begin = np.concatenate([self.begin, begins])[order]
        self.size = np.concatenate([self.size, sizes])[order]
        return begins


class Encoder:
    """Encodes batches with a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the tokenizer takes out of a text before it looks at words.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.known = Known()
        #: Whether a token begins with a space.
        self.spaced = np.zeros(self.vocabulary, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith(SPACE_BYTE)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one by one: all ids, and how many each text has."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lists = [np.array(e.ids, dtype=np.uint32) for e in found]
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        return (np.concatenate(lists) if lists else np.zeros(0, np.uint32)), lengths

    def _spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " piece" for pieces without white space, encoded as one running text.

        No id goes over a space, and only the first of a piece begins with one.
        """
        texts = [" " + " ".join(pieces[i : i + 100]) for i in range(0, len(pieces), 100)]
        ids, _ = self._each(texts)
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(pieces):
            raise ValueError("the tokenizer is not byte-level with spaces at the start of words")
        return ids, np.diff(np.append(starts, len(ids)))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where ``known`` has the ids of each " word", and how many; new words are encoded."""
        values = words.to_pylist()
        digests = b"".join([xxhash.xxh3_128_digest(w) for w in values])
        keys = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
        if len(self.known.key) > MOST_KNOWN:
            self.known = Known()
        begins, sizes, missing = self.known.find(keys)
        new = words.filter(pa.array(missing))
        blank = np.asarray(pc.match_substring_regex(new, "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x{85}]"), dtype=bool)
        blank |= np.asarray(pc.equal(new, ""), dtype=bool)
        plain_ids, plain_n = self._spaced(new.filter(pa.array(~blank)).to_pylist())
        other_ids, other_n = self._each([" " + w for w in new.filter(pa.array(blank)).to_pylist()])
        place = np.concatenate([np.flatnonzero(missing)[~blank], np.flatnonzero(missing)[blank]])
        n = np.concatenate([plain_n, other_n])
        begins[place] = self.known.add(keys[place], np.concatenate([plain_ids, other_ids]), n)
        sizes[place] = n
        return begins, sizes

    def _by_hand(self, pieces: pa.LargeListArray, texts: pa.Array, odd: np.ndarray) -> pa.LargeListArray:
        """Replace the pieces of texts that have a space beside other white space."""
        rows = np.arange(len(texts))
        cut = [SINGLE_SPACE.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        order = np.argsort(np.concatenate([rows[~odd], rows[odd]]), kind="stable")
        both = pa.concat_arrays([pieces.filter(pa.array(~odd)), pa.array(cut, type=pieces.type)])
        return both.take(pa.array(order))

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Texts cut at their single spaces: codes, bounds of the texts, distinct pieces."""
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        trimmed = pc.utf8_trim_whitespace(coded.dictionary)
        edge = pc.or_(pc.not_equal(trimmed, coded.dictionary), pc.equal(coded.dictionary, ""))
        bounds = np.asarray(cut.offsets, dtype=np.int64)
        codes = np.asarray(coded.indices, dtype=np.int64)
        if pc.any(edge).as_py():
            counts = np.concatenate([[0], np.cumsum(np.asarray(edge, dtype=bool)[codes])])
            cut = self._by_hand(cut, texts, np.diff(counts[bounds - bounds[0]]) > 0)
            coded = cut.flatten().dictionary_encode()
            bounds = np.asarray(cut.offsets, dtype=np.int64)
            codes = np.asarray(coded.indices, dtype=np.int64)
        return codes.copy(), bounds - bounds[0], coded.dictionary

    def _distinct(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " piece" for distinct pieces.

        A comma or full stop behind a letter is a piece of its own to the tokenizer, so words
        with and without one are encoded once.
        """
        stopped = np.asarray(pc.match_substring_regex(distinct, "\\p{L}[.,]$"), dtype=bool)
        base = pc.if_else(pa.array(stopped), pc.utf8_rtrim(distinct, ".,"), distinct)
        coded = base.dictionary_encode()
        begins, sizes = self._words(coded.dictionary)
        stop_ids, stop_n = self._each([".", ","])
        flat = np.concatenate([self.known.ids, stop_ids])
        begins = np.concatenate([begins, len(self.known.ids) + np.cumsum(stop_n) - stop_n])
        sizes = np.concatenate([sizes, stop_n])
        stop = len(coded.dictionary) + np.asarray(pc.ends_with(distinct, ","), dtype=np.int64)
        words = np.asarray(coded.indices, dtype=np.int64)
        parts = np.stack([words, np.where(stopped, stop, -1)], axis=1)
        ids, _ = gathered(flat, begins, sizes, parts[parts >= 0])
        return ids, (sizes[parts] * (parts >= 0)).sum(axis=1)

    def encode(self, texts: pa.Array | pa.ChunkedArray, end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and where each text's begin; ``end`` closes each.

        Texts that hold the string of an added token are encoded whole by the library.
        """
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        holds = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            holds |= np.asarray(pc.match_substring(texts, content), dtype=bool)
        if not holds.any():
            return self._encode(texts, end)
        ids, bounds = self._encode(texts.filter(pa.array(~holds)), end)
        whole, n = self._each(texts.filter(pa.array(holds)).to_pylist())
        if end is not None:
            whole, n = np.insert(whole, np.cumsum(n), np.uint32(end)), n + 1
        lengths = np.concatenate([np.diff(bounds), n])
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([np.flatnonzero(~holds), np.flatnonzero(holds)])] = np.arange(len(texts))
        return gathered(np.concatenate([ids, whole]), np.cumsum(lengths) - lengths, lengths, order)

    def _encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        codes, bounds, distinct = self.pieces(texts)
        first = bounds[:-1]
        # After the distinct pieces come the first pieces, without a space, and the end.
        flat, lengths = self._distinct(distinct)
        first_ids, first_n = self._each(distinct.take(pa.array(codes[first])).to_pylist())
        codes[first] = len(distinct) + np.arange(len(first))
        flat, lengths = np.concatenate([flat, first_ids]), np.concatenate([lengths, first_n])
        if end is not None:
            flat, lengths = np.append(flat, np.uint32(end)), np.append(lengths, 1)
            codes = np.insert(codes, bounds[1:], len(lengths) - 1)
            bounds = bounds + np.arange(len(bounds))
        ids, ends = gathered(flat, np.cumsum(lengths) - lengths, lengths, codes)
        return ids, ends[bounds]


def gathered(
    flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The lists that ``codes`` name, one after the other, and where each begins and the last ends."""
    each = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    return flat[np.arange(ends[-1]) + np.repeat(begins[codes] - ends[:-1], each)], ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The process's encoder, so that later batches and tasks find the words of earlier ones."""
    return Encoder(path)


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
