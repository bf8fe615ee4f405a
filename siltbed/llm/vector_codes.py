"""Product codes of vectors by ball k-means.

A vector is cut into equal parts and every part is replaced by the number of the nearest
entry of its position's codebook. Entries are refined by k-means in whole numbers. The
search around an entry uses its ball, the parts that chose it in the round before: with
the radius r of the ball, only entries within 2 r of its centre can be nearer to any of
them. A part at distance d from its centre stays if half the way to the nearest other entry
is longer (the stable core); otherwise the neighbours in reach, sorted by distance, form
rings, and only those within 2 d of the centre are looked at. Nothing is approximated, so
the entry found is the nearest, the lowest number among equals.

Assignments are narrow passes. From each task come sums per entry, which do not grow with
the rows; the codebooks built from them on the driver are a fixed number of integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from siltbed.sources.session import staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Steps of a component from one whole number to the next.
SCALE = 256
ROWS = 2048


def part_bounds(size: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * size // parts, (i + 1) * size // parts) for i in range(parts)]


def most_value(size: int) -> int:
    """Integers beyond this are set to it, so that squared distances fit 64 bits: 2^19 for 64 components of +-2^19."""
    return 1 << ((62 - max(size, 1).bit_length()) // 2 - 1)


def quantised(vectors: pa.ListArray, size: int) -> np.ndarray:
    """floor(256 x) of all components, a row per vector."""
    values = np.asarray(vectors.flatten(), dtype=np.float64).reshape(-1, size)
    most = most_value(size)
    return np.clip(np.floor(values * SCALE), -most, most).astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


def nearest(x: np.ndarray, entries: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each part the nearest entry, its squared distance; and how many distances it took.

    ``code`` names for each part the entry in whose ball it lies; any will do.
    """
    own = squared(x, entries[code])
    between = squared(entries[:, None, :], entries[None, :, :])
    radius = np.full(len(entries), -1, np.int64)
    np.maximum.at(radius, code, own)
    order = np.argsort(between, axis=1, kind="stable")
    apart = np.take_along_axis(between, order, axis=1)
    neighbours = (apart <= 4 * radius[:, None]).sum(axis=1)
    best, found, taken = own.copy(), code.copy(), len(x)
    # Points whose ball has neighbours, outside of its stable core.
    nearest_other = np.where(np.eye(len(entries), dtype=bool), np.iinfo(np.int64).max, between).min(axis=1)
    ring = np.flatnonzero((neighbours[code] > 1) & (4 * own >= nearest_other[code]))
    reach = np.zeros(len(ring), np.int64)
    for k in range(int(neighbours.max(initial=0))):
        reach += (apart[code[ring], k] <= 4 * own[ring]) & (k < neighbours[code[ring]])
    ring, reach = ring[np.argsort(-reach, kind="stable")], -np.sort(-reach)
    for k in range(int(reach.max(initial=0))):
        now = ring[: np.searchsorted(-reach, -k, side="left")]
        other = order[code[now], k]
        d = squared(x[now], entries[other])
        taken += len(now)
        nearer = (d < best[now]) | ((d == best[now]) & (other < found[now]))
        best[now[nearer]], found[now[nearer]] = d[nearer], other[nearer]
    return found, best, taken


def assigned(rows: DataFrame, books: np.ndarray, bounds: list[tuple[int, int]], kinds: dict[str, StructField]) -> DataFrame:
    """``rows`` (id, label, q, code) with codes for ``books``, and the error of each row.

    ``books`` has the entries of all parts side by side: (entries, size).
    """
    schema = StructType([*kinds.values(), StructField("code", BinaryType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                q = np.asarray(part.column("q").flatten(), dtype=np.int64).reshape(part.num_rows, -1)
                before = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(-1, len(bounds))
                codes = np.zeros((part.num_rows, len(bounds)), np.uint8)
                error = np.zeros(part.num_rows, np.int64)
                for p, (low, high) in enumerate(bounds):
                    found, d, _ = nearest(q[:, low:high], books[:, low:high], before[:, p].astype(np.int64))
                    codes[:, p] = found
                    error += d
                raw = [c.tobytes() for c in codes]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("q"), pa.array(raw, pa.binary()), pa.array(error)],
                    names=["id", "label", "q", "code", "error"],
                )

    return rows.select("id", "label", "q", "code").mapInArrow(run, schema)


def refined(rows: DataFrame, books: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Every entry becomes the mean, rounded down, of the parts that chose it; unused ones stay."""
    entries, size = books.shape
    owner = np.concatenate([np.full(high - low, p) for p, (low, high) in enumerate(bounds)]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((entries, size), np.int64), np.zeros((entries, len(bounds)), np.int64)
        for batch in batches:
            q = np.asarray(batch.column("q").flatten(), dtype=np.int64).reshape(batch.num_rows, -1)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, len(bounds))
            for i in range(size):
                np.add.at(sums[:, i], codes[:, owner[i]], q[:, i])
            for p in range(len(bounds)):
                counts[:, p] += np.bincount(codes[:, p], minlength=entries)
        both = np.concatenate([sums.ravel(), counts.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["place", "value"])

    partial = rows.select("q", "code").mapInArrow(run, "place long, value long")
    total = partial.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    flat = [0] * (entries * (size + len(bounds)))
    for place, value in total.collect():  # As many rows as the codebooks have numbers.
        flat[place] = int(value)
    out = books.copy()
    for e in range(entries):
        for i in range(size):
            n = flat[entries * size + e * len(bounds) + owner[i]]
            if n:
                out[e, i] = flat[e * size + i] // n
    return out


def books_digest(books: np.ndarray, bounds: list[tuple[int, int]]) -> str:
    numbers = [str(v) for low, high in bounds for entry in books[:, low:high].tolist() for v in entry]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Left out are rows whose vector is null, empty, holds a null, NaN or infinite component, or
    has another length than that of the smallest id kept. Codebooks start as the parts of the
    ``entries`` smallest ids, null ids last and equal ids by their vector; with fewer rows they
    are smaller. Rows may repeat and labels may be null: null labels are one label. A length
    that ``parts`` does not divide is cut as evenly as can be. Components are whole 256ths,
    those beyond ``most_value`` 256ths set to it. Further columns are not read. An empty table
    gives no rows.
    """
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")
    x = F.col(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) > 0)).where(~odd)
    kept = kept.select(F.col(id).alias("id"), F.col(label).alias("label"), x.alias("x"))
    order = [F.col("id").asc_nulls_last(), F.col("x").asc()]
    one = kept.orderBy(*order).limit(1).select(F.size("x").alias("n")).first()
    size = one["n"] if one else parts
    bounds = part_bounds(size, parts)
    fields = {f.name: f for f in kept.schema.fields}
    like = StructType.fromDDL("q array<int>, code binary")
    kinds = {"id": fields["id"], "label": fields["label"], "q": like["q"]}
    kinds = {name: StructField(name, f.dataType, True) for name, f in kinds.items()}

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                q = quantised(part.column("x"), size).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * size, pa.int32()), pa.array(q.ravel()))
                none = pa.array([bytes(parts)] * len(q), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), lists, none], names=["id", "label", "q", "code"]
                )

    schema = StructType([*kinds.values(), StructField("code", BinaryType())])
    rows = staged(kept.where(F.size("x") == size).mapInArrow(quantise, schema))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    books = np.array([r["q"] for r in first], dtype=np.int64).reshape(-1, size)
    if len(books):
        for _ in range(rounds):
            rows = staged(assigned(rows, books, bounds, kinds))
            books = refined(rows, books, bounds)
        rows = staged(assigned(rows, books, bounds, kinds).drop("q"))
    else:
        rows = rows.withColumn("error", F.lit(0).cast("long")).drop("q")
    summed = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = rows.join(summed, rows["label"].eqNullSafe(summed["of"]))
    return both.select(
        F.col("id").alias(id),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books_digest(books, bounds)).alias("codebooks_sha256"),
    )
