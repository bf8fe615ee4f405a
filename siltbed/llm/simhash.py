"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are compared inside buckets that share one of several bit blocks. A bucket's
fingerprints stand as bit planes: one machine word holds the same bit of 64 of them. A
query's distance to all of them grows plane by plane in carry-save counters, one word
operation for 64 distances, and a query leaves a word as soon as all its distances to the
64 in it exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.components import connected_components
from siltbed.llm.words import WordBatch, slices
from siltbed.sources.session import staged

BITS = 64
SEED = 42
#: Fingerprints that are compared at once; larger buckets are cut into chunks of this size.
CHUNK = 2048
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a batch of lower-cased texts, and where each text's begin."""
    words = WordBatch(texts)
    vocabulary = [w.encode() for w in words.distinct.to_pylist()]
    hashes = []
    offsets = np.zeros(len(words.offsets), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for row in range(len(offsets) - 1):
        codes = words.codes[words.offsets[row] : words.offsets[row + 1]].tolist()
        tokens = [vocabulary[c] for c in codes]
        if not tokens:
            shingles = []
        elif len(tokens) < width:
            shingles = [b" ".join(tokens)]
        else:
            shingles = map(b" ".join, zip(*[tokens[i:] for i in range(width)]))
        found = [digest(s, SEED) for s in shingles]
        hashes.append(np.array(found, dtype=np.uint64))
        offsets[row + 1] = offsets[row] + len(found)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), offsets


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, the bits set in more than half of its hashes."""
    counts = np.diff(offsets)
    out = np.zeros(len(counts), dtype=np.uint64)
    if not len(hashes):
        return out
    full = np.flatnonzero(counts)
    starts = offsets[:-1][full]
    for bit in range(BITS):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), starts)
        out[full] |= (2 * ones.astype(np.int64) > counts[full]).astype(np.uint64) << np.uint64(bit)
    return out


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased, other letters kept; null as empty."""
    return pc.ascii_lower(pc.fill_null(texts, ""))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fingerprint as BIGINT bits) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, rows=512):
            hashes, offsets = shingle_hashes(lower_ascii(part.column(1)), width)
            bits = majority_bits(hashes, offsets).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bits)], names=[id, "fingerprint"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, fingerprint long")


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 of them in a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def open_words(beyond: np.ndarray) -> np.ndarray:
    """Places of the words in which some distance is still within the radius."""
    return np.flatnonzero(beyond != ALL)


def within_radius(queries: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, value) of all pairs that differ in at most ``radius`` bits.

    ``radius`` is at most 3: two carry-save counter words hold the distances 0 to 3 and a
    third word remembers those beyond.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius must be 0 to 3")
    planes = planes_of(values)
    words = planes.shape[1]
    # One entry per query and word of 64 values, dropped as soon as all 64 are beyond.
    query, word = np.divmod(np.arange(len(queries) * words), max(words, 1))
    ones = np.zeros(len(query), dtype=np.uint64)
    twos, beyond = np.zeros_like(ones), np.zeros_like(ones)
    if len(values) % 64:
        beyond[word == words - 1] = ALL << np.uint64(len(values) % 64)
    for bit in range(BITS):
        asked = np.where((queries >> np.uint64(bit)) & np.uint64(1), ALL, np.uint64(0))
        differs = planes[bit][word] ^ asked[query]
        carry = ones & differs
        ones ^= differs
        beyond |= twos & carry
        twos ^= carry
        if bit % 8 == 7 and bit > 8:
            live = open_words(beyond)
            if len(live) < len(beyond):
                query, word = query[live], word[live]
                ones, twos, beyond = ones[live], twos[live], beyond[live]
                if not len(live):
                    break
    if radius < 3:
        distance_3, distance_2 = ones & twos, twos & ~ones
        beyond |= distance_3
        if radius < 2:
            beyond |= distance_2
        if radius < 1:
            beyond |= ones
    hits = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    entry, place = np.nonzero(hits)
    return query[entry], 64 * word[entry] + place


class Forest:
    """Union-find over positions; ``links`` gives every member its smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Hook larger roots to smaller ones until all pairs agree."""
        parent = self.parent
        while True:
            ra, rb = parent[a], parent[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent[:] = up


def bucket_links(fp: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """Links (n, 2) that connect what is within the radius inside each bucket.

    Rows come sorted by bucket. Only a spanning forest of each bucket is returned, at most
    one link per row, so a group of near copies does not become all its pairs.
    """
    n = len(fp)
    forest = Forest(n)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [n]])
    # Small buckets share a comparison; a pair counts only inside its own bucket.
    begin = 0
    while begin < len(starts):
        stop = begin + 1
        while stop < len(starts) and ends[stop] - starts[begin] <= CHUNK // 2:
            stop += 1
        s, e = starts[begin], ends[stop - 1]
        if e - s > 1:
            a, b = within_radius(fp[s:e], fp[s:e], radius)
            ok = (a < b) & (bucket[s + a] == bucket[s + b])
            forest.join(s + a[ok], s + b[ok])
        begin = stop
    child = np.flatnonzero(forest.parent != np.arange(n))
    return np.stack([fp[forest.parent[child]], fp[child]], axis=1)


def link_fingerprints(distinct: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """Links between distinct fingerprints within the radius, enough to connect all of them.

    With one more block than the radius, two such fingerprints share a block. Buckets of a
    block value are sized by an aggregate first. A bucket of more than ``CHUNK`` members is
    cut into chunks by a digest and every two chunks meet in a task of their own, so no
    task holds more than two chunks however hot a block value is, and no pair is left out.
    """
    blocks = blocks or radius + 1
    width = BITS // blocks
    keyed = distinct.select(
        "fingerprint",
        F.posexplode(
            F.array(
                *[
                    F.shiftrightunsigned("fingerprint", i * width).bitwiseAND(F.lit((1 << width) - 1))
                    for i in range(blocks)
                ]
            )
        ).alias("block", "value"),
    )
    sizes = keyed.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(sizes, ["block", "value"])
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint"), chunks).cast("int")
    low = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.least(c, mine))
    high = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.greatest(c, mine))
    met = sized.select(
        "fingerprint", "block", "value", mine.alias("chunk"), F.explode(F.arrays_zip(low.alias("a"), high.alias("b"))).alias("pair")
    ).select("fingerprint", "block", "value", "chunk", "pair.a", "pair.b")
    # Chunks with themselves, and with each other, are one comparison group each.
    groups = met.withColumn("bucket", F.xxhash64("block", "value", "a", "b"))
    groups = groups.repartition("bucket").sortWithinPartitions("bucket", "block", "value", "a", "b", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp, bucket in whole_groups(batches):
            links = bucket_links(fp, bucket, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(links[:, 0].view(np.int64)), pa.array(links[:, 1].view(np.int64))], names=["a", "b"]
            )

    return groups.select("fingerprint", "bucket", "block", "value", "a", "b").mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted rows as arrays that never cut a comparison group; a group has two chunks at most."""
    rest: pd.DataFrame | None = None
    keys = ["bucket", "block", "value", "a", "b"]
    for batch in batches:
        frame = batch.to_pandas()
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        same = (rest[keys] == rest[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.argmax(same)) if same.any() else 0
        if cut:
            yield _coded(rest.iloc[:cut], keys)
            rest = rest.iloc[cut:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield _coded(rest, keys)


def _coded(frame: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    values = frame[keys].to_numpy()
    bucket = np.concatenate([[0], np.cumsum((values[1:] != values[:-1]).any(axis=1))])
    return frame["fingerprint"].to_numpy(dtype=np.int64).view(np.uint64), bucket


def fingerprint_roots(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """The columns of distinct fingerprints and ``root``, the smallest one of their component."""
    roots = connected_components(link_fingerprints(distinct, radius))
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
    return named.select(*distinct.columns, F.coalesce("root", "fingerprint").alias("root"))


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing
    bits. Texts without words have fingerprint zero and are linked like any other. Null ids
    stay in the result; they are smaller than no id, so a group of null ids only has a null
    component. Rows may repeat; further columns are not read. An empty table gives no rows.
    """
    marked = staged(fingerprints(docs, id, text, width))
    distinct = marked.groupBy("fingerprint").agg(F.min(id).alias("smallest"))
    grouped = fingerprint_roots(distinct, radius)
    smallest = grouped.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = grouped.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        id, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
