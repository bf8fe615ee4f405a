"""Hierarchical packing of documents into sequences of several context sizes.

Whole windows of the longest size are cut off a document; what remains is routed to the
tier of the smallest size that holds it. Tiers are packed from long to short. A gap in a
long window takes the largest remainder that fits it, from the same tier or a shorter one,
and if none fits, the head of one, whose tail is routed anew. So windows are full; only the
last remainders of a task are not enough for one, and these are laid into windows of the
sizes their length is the sum of, powers of two down to 1, which need no padding.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siltbed.llm.tokens import default_tokenizer, encoder, ids_crc32
from siltbed.llm.words import slices

#: Context sizes; powers of two.
TIERS = (128, 256, 512, 1024)
#: Remainders that a task holds before it packs them.
POOL = 4096
#: Tokens of the sequences of one step group.
STEP_TOKENS = 8 * 1024
#: Sequence ids leave this many to each task.
PER_TASK = 1 << 40
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)
FIELDS = pa.schema(
    [(n, pa.int32() if n == "tier" else pa.int64()) for n in (f.split()[0] for f in SCHEMA.split(", "))]
)


class Piece:
    """A cut of a document."""

    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id: int | None, doc_tokens: int, start: int, ids: np.ndarray):
        self.doc_id, self.doc_tokens, self.start, self.ids = doc_id, doc_tokens, start, ids

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:n]),
            Piece(self.doc_id, self.doc_tokens, self.start + n, self.ids[n:]),
        )


class Packer:
    """Packs the pieces of one task; ``rows`` holds what has been placed."""

    def __init__(self, first_sequence: int, tiers: tuple[int, ...] = TIERS, pool: int = POOL):
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
            raise ValueError("tiers must be ascending powers of two")
        self.tiers, self.most, self.limit = tiers, tiers[-1], pool
        self.next_sequence = self.first = first_sequence
        self.pools: dict[int, list[tuple[int, int]]] = {t: [] for t in tiers}
        self.held: dict[int, Piece] = {}
        self.number = 0
        self.rows: list[tuple] = []
        self.groups = 0
        #: For each tier: the group that is being filled and the tokens it still takes.
        self.open_groups: dict[int, list[int]] = {}

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        piece = Piece(doc_id, len(ids), 0, ids)
        while len(piece.ids) >= self.most:
            window, piece = piece.cut(self.most)
            self.close([window], self.most)
        if len(piece.ids):
            self.route(piece)
        if len(self.held) >= self.limit:
            self.pack()

    def route(self, piece: Piece) -> None:
        """Into the pool of the smallest tier that holds it; pools are sorted by length."""
        n = len(piece.ids)
        tier = self.tiers[bisect.bisect_left(self.tiers, n)]
        bisect.insort(self.pools[tier], (n, self.number))
        self.held[self.number] = piece
        self.number += 1

    def take(self, tier: int, place: int) -> Piece:
        return self.held.pop(self.pools[tier].pop(place)[1])

    def fitting(self, tier: int, gap: int) -> Piece | None:
        """The largest held piece of at most ``gap`` ids, from this tier down."""
        for t in reversed(self.tiers[: self.tiers.index(tier) + 1]):
            place = bisect.bisect_right(self.pools[t], (gap, self.number)) - 1
            if place >= 0:
                return self.take(t, place)
        return None

    def shortest(self) -> Piece | None:
        for t in self.tiers:
            if self.pools[t]:
                return self.take(t, 0)
        return None

    def pack(self) -> None:
        """Fill windows tier by tier until no whole one can be filled."""
        for tier in reversed(self.tiers):
            while self.pools[tier]:
                window = [self.take(tier, len(self.pools[tier]) - 1)]
                gap = tier - len(window[0].ids)
                while gap:
                    piece = self.fitting(tier, gap)
                    if piece is None:
                        piece = self.shortest()
                        if piece is None:
                            break
                        piece, tail = piece.cut(gap)
                        self.route(tail)
                    window.append(piece)
                    gap -= len(piece.ids)
                if gap:
                    # Nothing else is held: these wait for the next round or the end.
                    for piece in window:
                        self.route(piece)
                    return
                self.close(window, tier)

    def finish(self) -> None:
        """Lay what is left into windows whose sizes are the powers of two of its sum."""
        self.pack()
        rest = [self.held[k] for k in sorted(self.held)]
        self.held, self.pools = {}, {t: [] for t in self.tiers}
        total = sum(len(p.ids) for p in rest)
        while total:
            size = min(self.most, 1 << (total.bit_length() - 1))
            window, gap = [], size
            while gap:
                piece = rest.pop(0)
                if len(piece.ids) > gap:
                    piece, tail = piece.cut(gap)
                    rest.insert(0, tail)
                window.append(piece)
                gap -= len(piece.ids)
            self.close(window, size)
            total -= size

    def close(self, window: list[Piece], size: int) -> None:
        group = self.open_groups.get(size)
        if group is None or group[1] < size:
            group = self.open_groups[size] = [self.groups, STEP_TOKENS]
            self.groups += 1
        group[1] -= size
        offset = 0
        for p in window:
            n = len(p.ids)
            self.rows.append(
                (p.doc_id, p.start, n, ids_crc32(p.ids), p.doc_tokens, self.next_sequence, offset, size, self.first + group[0])
            )
            offset += n
        self.next_sequence += 1


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``tier`` is the sequence's length, all of it filled. ``step_group`` gathers sequences of
    one tier with equal token sums, so that the steps of a training run weigh the same.
    Every task packs the rows it reads; nothing is shuffled, and a task repeated after a
    lost executor packs the same rows in the same way. Null text is empty and holds the end
    id only; rows with equal or null ids are documents of their own. Further columns are
    not read. An empty table has no pieces.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        packer = Packer(TaskContext.get().partitionId() * PER_TASK, tiers)
        for part in slices(batches, 1):
            ids, bounds = encode.encode(part.column(1))
            for row, doc_id in enumerate(part.column(0).to_pylist()):
                packer.add(doc_id, ids[bounds[row] : bounds[row + 1]])
            # Held pieces must not keep the ids of whole batches.
            for piece in packer.held.values():
                piece.ids = piece.ids.copy()
            yield taken(packer)
        packer.finish()
        yield taken(packer)

    def taken(packer: Packer) -> pa.RecordBatch:
        rows, packer.rows = packer.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, FIELDS)], schema=FIELDS)

    return docs.select(id, text).mapInArrow(run, SCHEMA)
