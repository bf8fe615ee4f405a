"""Near-duplicates by the exact similarity of five-word shingle sets.

Two texts are near copies if the Jaccard similarity of their shingle sets is 0.8 or more.
SimHash proposes first: fingerprints of the shingle sets, compared bit-sliced inside buckets
as in ``simhash``. At 0.8 a tenth to a sixth of the bits differ, which is too many for blocks
of whole equal bits, so the pairs beyond its radius are proposed by bands of min-wise hashes:
a pair at 0.8 shares none of the bands once in 300,000 times and a pair above it far less
often. Every proposal is settled on the sets themselves before it becomes a link.

What SimHash has connected is one component to all that follows. The members of a bucket are not paired with each other. In each round one of them, another
each time, is held against those not connected with it yet, so a round proposes no more
pairs than there are members, however large the bucket. The first is the one that meets most
others in all its buckets: of copies that were changed apart, the one nearest to their
common text, whose near copies are more than those of any copy by chance. What is still open when rounds find
little is paired within classes of set sizes, as sets of other sizes cannot be 0.8 alike. A
sketch of two bits per min-wise hash rules pairs out inside the join, and so does a count of
the shingles that a set shares with any other open one, and so does what two sets have apart
from the most central of their bucket: copies of one text that were changed apart differ by
what was changed in both, so a large group of such copies makes few pairs among itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.llm.components import connected_components
from siltbed.llm.simhash import SEED, link_fingerprints, lower_ascii, majority_bits
from siltbed.llm.words import WordBatch, combine, mix, slices
from siltbed.sources.session import staged

#: Words of a shingle.
WIDTH = 5
#: Bands and min-wise hashes of a band.
BANDS, ROWS = 24, 4
#: Rounds at most in which members of buckets are held against one of them, and the share of
#: a round's pairs that must become links for another.
LEADER_ROUNDS, LEAST_FOUND = 3, 0.05
#: Of the sketch's 2-bit values, those that may differ between sets that are 0.8 alike: three
#: in twenty do on average, so 34 of 96 are over five standard deviations more.
MOST_DIFFER = 34
#: Stands for the words that a text of fewer than ``WIDTH`` lacks.
PAD = np.uint64(0x5851F42D4C957F2D)
SALTS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, -1)
#: Longs of a sketch.
SKETCH = BANDS * ROWS * 2 // 64


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and where each text's begin.

    A-Z count as a-z. A text of fewer than five words has one shingle, one without words none.
    """
    words = WordBatch(lower_ascii(texts))
    vocabulary = np.array([xxhash.xxh64_intdigest(w.encode(), SEED) for w in words.distinct.to_pylist()], dtype=np.uint64)
    codes = vocabulary[words.codes]
    counts = words.counts()
    sizes = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), sizes)
    if not len(row):
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    at = words.offsets[:-1][row] + np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
    end = words.offsets[1:][row]
    hashes = np.zeros(len(row), np.uint64)
    for j in range(WIDTH):
        inside = at + j < end
        hashes = combine(hashes, np.where(inside, codes[np.minimum(at + j, len(codes) - 1)], PAD))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=len(counts)))])
    return hashes[first], offsets.astype(np.int64)


def set_digests(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A digest of every set; equal sets have equal ones."""
    ends = offsets.tolist()
    return np.array(
        [xxhash.xxh64_intdigest(hashes[s:e].tobytes(), SEED) for s, e in zip(ends, ends[1:])], dtype=np.uint64
    ).view(np.int64)


def band_digests(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every set that is not empty, the digests of its bands and its sketch.

    A band is made of the least hashes under some orders; the sketch holds two bits of each.
    """
    starts = offsets[:-1][np.diff(offsets) > 0]
    bands, sketch = np.zeros((len(starts), BANDS), np.uint64), np.zeros((len(starts), SKETCH), np.uint64)
    if not len(starts):
        return bands, sketch
    for band in range(BANDS):
        digest = np.full(len(starts), band, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat((hashes ^ SALTS[0, k]) * (SALTS[1, k] | np.uint64(1)), starts)
            digest = combine(digest, least)
            sketch[:, k // 32] |= (mix(least) >> np.uint64(62)) << np.uint64(2 * (k % 32))
        bands[:, band] = digest
    return bands, sketch


def _list_of(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64).ravel()))


def marked(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, node, size, fingerprint, bands, sketch) of every row.

    ``row`` holds all columns, ``node`` is a digest of the shingle set, ``size`` its size and
    ``fingerprint`` its SimHash; a text without words has no bands and no sketch.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    more = StructType.fromDDL("node long, size int, fingerprint long, bands array<long>, sketch array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, rows=512, most=1 << 20):
            hashes, offsets = shingle_sets(part.column(1))
            bands, sketch = band_digests(hashes, offsets)
            size = np.diff(offsets)
            before = np.concatenate([[0], np.cumsum(size > 0)])
            found = [
                pa.array(set_digests(hashes, offsets)),
                pa.array(size, pa.int32()),
                pa.array(majority_bits(hashes, offsets).view(np.int64)),
                _list_of(bands, before * BANDS),
                _list_of(sketch, before * SKETCH),
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), *found], names=["row", *more.names])

    return rows.mapInArrow(run, StructType([rows.schema["row"], *more.fields]))


def shingled(nodes: DataFrame) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, rows=512, most=1 << 20):
            hashes, offsets = shingle_sets(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), _list_of(hashes, offsets)], names=["node", "shingles"])

    return nodes.mapInArrow(run, "node long, shingles array<long>")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have a similarity of 0.8 or more."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size("of_a") + F.size("of_b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    # i / (both - i) >= 4 / 5
    return pairs.join(a, "a").join(b, "b").where(9 * shared >= 4 * both).select("a", "b")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that connect all whose fingerprints are linked by SimHash.

    Nodes of one fingerprint are paired with the smallest of them, which stands for it.
    """
    firsts = nodes.groupBy("fingerprint").agg(F.min("node").alias("first"))
    same = nodes.join(firsts, "fingerprint").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    of = lambda end: firsts.select(F.col("fingerprint").alias(end), F.col("first").alias(f"first_{end}"))
    linked = link_fingerprints(firsts.select("fingerprint")).distinct().join(of("a"), "a").join(of("b"), "b")
    return same.union(linked.select("first_a", "first_b"))


def can_be_similar(one: str, other: str) -> Column:
    """Whether sizes and sketches of two members allow a similarity of 0.8."""
    x, y = F.col(f"{one}.size"), F.col(f"{other}.size")
    differ = F.lit(0)
    for i in range(SKETCH):
        bits = F.col(f"{one}.sketch")[i].bitwiseXOR(F.col(f"{other}.sketch")[i])
        pairs = bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(pairs)
    return (5 * F.least(x, y) >= 4 * F.greatest(x, y)) & (differ <= MOST_DIFFER)


def size_class(size: Column) -> Column:
    """Sets that are 0.8 alike are in the same class or in neighbouring ones, as 1.3 > 5 / 4."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1.3))).cast("int")


def with_shared(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """``open_`` with ``shared``: how many of a set's shingles some other open set has too."""
    mine = sets.join(open_.select("node").distinct(), "node", "left_semi")
    shingles = mine.select("node", F.explode("shingles").alias("shingle"))
    alone = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    counted = alone.groupBy("node").agg(F.count("*").alias("alone"))
    return open_.join(counted, "node", "left").withColumn("shared", F.col("size") - F.coalesce("alone", F.lit(0))).drop("alone")


def central() -> Column:
    """Orders members of a bucket, those that meet most others in all their buckets first."""
    return F.struct(-F.col("met"), F.xxhash64("node", F.lit(0)))


def with_met(members: DataFrame) -> DataFrame:
    """``members`` with ``met``: the sizes of all the buckets of a node, summed."""
    return members.join(members.groupBy("node").agg(F.sum("n").alias("met")), "node")


def with_apart(held: DataFrame, sets: DataFrame) -> DataFrame:
    """``held`` with ``apart`` and ``common``, as seen from the bucket's most central member.

    ``apart`` counts the shingles that only one of a set and the central one has, ``common``
    those of them that could be so for another set as well: not the ones that are in no other
    set. Two sets differ by all of ``apart`` of both but what they have in common.
    """
    centers = with_met(held).groupBy("bucket").agg(F.min_by("node", central()).alias("center"))
    placed = staged(held.join(centers, "bucket"))
    one = sets.select("node", F.col("shingles").alias("of_node"))
    other = sets.select(F.col("node").alias("center"), F.col("shingles").alias("of_center"))
    shared = F.size(F.array_intersect("of_node", "of_center"))
    apart = (F.size("of_node") + F.size("of_center") - 2 * shared).alias("apart")
    seen = placed.select("node", "center").distinct().join(one, "node").join(other, "center").select("node", "center", apart)
    alone = F.when(F.col("node") == F.col("center"), 0).otherwise(F.col("size") - F.col("shared"))
    return placed.join(seen, ["node", "center"]).withColumn("common", F.col("apart") - alone)


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after some more links; components known so far count as one node each."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = staged(roots.union(ends.join(roots, "node", "left_anti").select("node", "node")))
    of = lambda end: known.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    merged = connected_components(links.join(of("a"), "a").join(of("b"), "b"), "root_a", "root_b")
    merged = merged.select(F.col("node").alias("old"), F.col("root").alias("new"))
    return staged(known.join(merged, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")))


def near_links(marks: DataFrame) -> DataFrame:
    """(node, root) of all shingle sets that are near others, by connected components.

    SimHash links come first. Links within what is already connected add nothing, so only
    members of a bucket that are not connected with its leader are held against it.
    """
    keyed = marks.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "fingerprint", "bands", "sketch")])
    banded = staged(keyed)
    proposed = staged(simhash_pairs(banded.where("size > 0").select("node", "fingerprint")))
    keyed = banded.withColumn("bucket", F.explode("bands")).drop("bands", "fingerprint")
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(keyed.join(shared, "bucket"))
    held = members.select("node").union(proposed.select(F.explode(F.array("a", "b")))).distinct()
    wanted = marks.select("node", "text").join(held, "node", "left_semi")
    sets = staged(shingled(wanted.groupBy("node").agg(F.min("text").alias("text"))))

    roots = staged(connected_components(similar(proposed, sets)))
    turn, last = 0, False
    while True:
        named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        place = F.xxhash64("node", F.lit(turn))
        if not turn:
            named, place = with_met(named), central()
        chosen = F.min_by(F.struct("root", "node", "size", "sketch"), place)
        leaders = named.groupBy("bucket").agg(chosen.alias("leader"), F.min("root").alias("r"), F.max("root").alias("s"))
        leaders = leaders.where("r < s").select("bucket", "leader")
        if not last:
            met = named.alias("member").join(leaders, "bucket").where(
                (F.col("root") != F.col("leader.root")) & can_be_similar("member", "leader")
            )
            # A node that stands in many buckets meets two of their leaders.
            ends = [f(F.col("leader.node")) for f in (F.min, F.max)]
            pairs = met.groupBy("node").agg(F.array_distinct(F.array(*ends)).alias("ends"))
            pairs = pairs.select(F.explode("ends").alias("a"), F.col("node").alias("b"))
        else:
            open_ = staged(named.join(leaders.select("bucket"), "bucket", "left_semi"))
            held = with_apart(with_shared(open_, sets), sets).join(banded.select("node", "bands"), "node")
            held = staged(held).withColumn("class", size_class(F.col("size")))
            left = held.withColumn("class", F.explode(F.array(*[F.col("class") + d for d in (-1, 0, 1)]))).alias("x")
            right = held.alias("y")
            meet = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.class") == F.col("y.class"))
            # What both have in common is shared: i / (both - i) >= 4 / 5 needs as much of it.
            enough = 9 * F.least(F.col("x.shared"), F.col("y.shared")) >= 4 * (F.col("x.size") + F.col("y.size"))
            # Sets that are 0.8 alike differ by a ninth of both sizes at most.
            differ = F.col("x.apart") + F.col("y.apart") - 2 * F.least(F.col("x.common"), F.col("y.common"))
            enough &= 9 * differ <= F.col("x.size") + F.col("y.size")
            # A pair that meets in many buckets is made in that of its first common band only.
            equal = F.zip_with("x.bands", "y.bands", lambda p, q: F.when(p == q, p))
            enough &= F.col("x.bucket") == F.get(F.array_compact(equal), F.lit(0))
            met = left.join(right, meet & (F.col("x.root") < F.col("y.root")) & enough & can_be_similar("x", "y"))
            pairs = met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        pairs = staged(pairs)
        asked = pairs.count()
        new = staged(similar(pairs, sets))
        found = new.count()
        if found:
            roots = joined_roots(roots, new)
        if last:
            return roots
        turn += 1
        last = turn == LEADER_ROUNDS or found <= LEAST_FOUND * asked


def with_group(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, group) of every row: all its columns, and the number of its near-duplicate group.

    Texts without words are one group. Rows are told apart by nothing, so copies, equal ids
    and null ids are rows like all others, and column names of the input cannot clash. An
    empty table stays empty.
    """
    marks = staged(marked(docs, text))
    roots = near_links(marks.select(F.col("row")[text].alias("text"), *marks.columns[1:])).withColumnRenamed("node", "of")
    named = marks.select("row", "node").join(roots, F.col("node") == F.col("of"), "left")
    return named.select("row", F.coalesce("root", "node").alias("group"))
