"""Order MinHash fingerprints: minima that remember their order in the text.

A text is its k-mers of code points, each with the number of its occurrence. For every one
of the seeds the ``l`` smallest hashed k-mers are selected, put back in text order and
hashed as a tuple. Two texts agree in a tuple if the same k-mers are smallest and stand in
the same order, so the share of equal tuples follows the edit distance and not only the set
of k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.words import combine, mix
from siltbed.sources.session import staged


#: Code points of a text in the keys that ranges are cut by.
KEY_CHARS = 64


@dataclass(frozen=True)
class Shape:
    """k-mer length in code points, number of tuples, k-mers in a tuple."""

    k: int = 5
    tuples: int = 32
    l: int = 2  # noqa: E741


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def numbered_kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A 32-bit digest of each k-mer with its occurrence number; short texts are one k-mer."""
    if not len(points):
        return np.zeros(0, dtype=np.uint32)
    k = min(k, len(points))
    n = len(points) - k + 1
    h = points[:n].copy()
    for i in range(1, k):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += points[i : i + n]
    h = mix(h)
    # Sorting digest and position together numbers the occurrences in text order. The upper
    # 32 bits of the digest tell k-mers apart well enough inside one text.
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    keyed.sort()
    upper = keyed >> np.uint64(32)
    fresh = np.concatenate([[True], upper[1:] != upper[:-1]])
    begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    number = np.arange(n) - begin
    out = np.empty(n, dtype=np.uint32)
    out[(keyed & np.uint64(0xFFFFFFFF)).astype(np.int64)] = (
        mix((upper << np.uint64(32)) + number.astype(np.uint64)) >> np.uint64(32)
    ).astype(np.uint32)
    return out


def multipliers(n: int) -> np.ndarray:
    """Odd numbers, one for each tuple; multiplying by one reorders all 32-bit digests."""
    return (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def fingerprint(text: str, shape: Shape) -> np.ndarray:
    """The tuple digests of a text, 32 bits each; zeros for the empty text."""
    kmers = numbered_kmers(code_points(text), shape.k)
    if not len(kmers):
        return np.zeros(shape.tuples, dtype=np.uint32)
    chosen = np.empty((shape.tuples, min(shape.l, len(kmers))), dtype=np.int64)
    for row, factor in enumerate(multipliers(shape.tuples)):
        order = kmers * factor
        # A scrambling after the product keeps neighbouring digests from moving together.
        order ^= order >> np.uint32(15)
        for i in range(chosen.shape[1]):
            chosen[row, i] = place = int(order.argmin())
            order[place] = 0xFFFFFFFF
    chosen.sort(axis=1)
    digest = np.arange(1, shape.tuples + 1, dtype=np.uint64)
    for column in kmers[chosen].T.astype(np.uint64):
        digest = combine(digest, column)
    return (digest >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as many code points of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


SCHEMA = (
    "part int, role string, doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, text string"
)
FIELDS = pa.schema(
    [
        ("part", pa.int32()),
        ("role", pa.string()),
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("text", pa.string()),
    ]
)


def compared(part: int, doc_id: int | None, text: str, own: np.ndarray, following: str, other: np.ndarray, shape: Shape) -> dict:
    changed = edited(text, following)
    changed_print = fingerprint(changed, shape)
    return {
        "part": part,
        "role": "row",
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest(),
        "fingerprint": own.tobytes(),
        "edited_fingerprint": changed_print.tobytes(),
        "near_edited": likeness(own, changed_print),
        "near_next": likeness(own, other),
        "text": None,
    }


def order_minhash(docs: DataFrame, shape: Shape = Shape(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Documents are dealt to tasks by ranges of their id, so a document's successor is the
    next row of its task. Only the last row of each task needs the first row of the next
    one; these two rows per task are matched in a step of their own. The last document is
    followed by the first. A single document is followed by itself. Rows with equal ids
    follow their text; a null id comes first; null text is empty. Further columns are not
    read. An empty table has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: tuple | None = None
        rows: list[dict] = []
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body = body or ""
                own = fingerprint(body, shape)
                if last is None:
                    rows.append({"part": part, "role": "first", "text": body})
                else:
                    rows.append(compared(part, *last, body, own, shape))
                last = (doc_id, body, own)
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=FIELDS)
                    rows = []
        if last is not None:
            rows.append({"part": part, "role": "last", "doc_id": last[0], "text": last[1]})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=FIELDS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, doc_id, body, following in zip(*[c.to_pylist() for c in batch.columns]):
                own, other = fingerprint(body, shape), fingerprint(following, shape)
                rows.append(compared(part, doc_id, body, own, following, other, shape))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=FIELDS)

    dealt = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The driver samples the range keys, so texts take part by their beginning only; a range
    # holds all rows that share one, and the sort inside it compares whole texts.
    ranges = dealt.repartitionByRange(F.col("doc_id"), F.substring("text", 1, KEY_CHARS))
    dealt = ranges.sortWithinPartitions("doc_id", "text")
    done = staged(dealt.mapInArrow(run, SCHEMA))
    # Task numbers without rows are skipped by numbering those that have some.
    by_part = Window.orderBy("part")
    heads = done.where("role = 'first'").select("part").withColumn("n", F.row_number().over(by_part))
    count = heads.agg(F.count("*")).scalar()
    firsts = done.where("role = 'first'").select("part", F.col("text").alias("following")).join(heads, "part")
    lasts = done.where("role = 'last'").select("part", "doc_id", "text").join(heads, "part")
    lasts = lasts.withColumn("n", F.col("n") % count + 1)
    met = lasts.join(firsts.select("n", "following"), "n").select("part", "doc_id", "text", "following")
    ends = met.mapInArrow(finish, SCHEMA)
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return done.where("role = 'row'").union(ends).select(
        F.col("doc_id").alias(id),
        "n_chars",
        hexed("edited_sha256"),
        hexed("fingerprint"),
        hexed("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
