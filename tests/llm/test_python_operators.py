"""Operators that SQL cannot express, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltbed.llm import records, simhash
from siltbed.llm.order_minhash import Shape, edited, fingerprint, order_minhash
from siltbed.llm.packing import Packer, pack_documents
from siltbed.llm.simhash import link_fingerprints, simhash_groups, within_radius
from siltbed.llm.tokens import default_tokenizer
from siltbed.llm.toxicity import Settings, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# -- SimHash ---------------------------------------------------------------------------


def plain_fingerprint(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius=3):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return [least[root(i)] for i in range(len(ids))]


def test_simhash_equals_plain_python(docs, rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components([r[0] for r in rows], prints)
    want = sorted((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, roots))
    assert sorted(map(tuple, simhash_groups(docs).collect())) == want


def test_simhash_of_nothing(no_docs):
    out = simhash_groups(no_docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_slices_count_like_integers(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    values = np.concatenate([base ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(2 * i)) for i in range(30)])
    a, b = within_radius(values, values, radius)
    want = {(i, j) for i, x in enumerate(values.tolist()) for j, y in enumerate(values.tolist()) if (x ^ y).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_hot_buckets_are_cut_and_lose_no_link(spark, monkeypatch):
    """Chains of near fingerprints in a bucket far beyond the chunk size stay connected."""
    monkeypatch.setattr(simhash, "CHUNK", 64)
    rng = random.Random(3)
    prints = {0}
    for _ in range(400):
        x = rng.choice(sorted(prints))
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(20, 62)
        prints.add(x)
    prints = sorted(prints)
    links = link_fingerprints(spark.createDataFrame([(p,) for p in prints], "fingerprint long")).collect()
    assert len(links) < 12 * 4 * len(prints)
    from siltbed.llm.components import connected_components

    roots = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r.node: r.root for r in roots}
    want = plain_components(prints, prints)
    assert [got.get(p, p) for p in prints] == want


# -- token records ------------------------------------------------------------------------


def test_records_round_trip(spark, docs, rows, encode, tmp_path):
    folder = f"file:{tmp_path}/run"
    manifest = records.write_records(docs, folder).collect()
    got = sorted(map(tuple, records.read_records(spark, folder).collect()), key=lambda r: r[1])
    start, want = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = encode(text)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    shard = manifest[0].shard
    whole = {r.doc_id: r.ids for r in records.read_records(spark, folder, with_ids=True).collect()}
    for n in reversed(range(manifest[0].n_records)):
        doc_id, ids = records.read_record(shard, n)
        assert ids.tolist() == whole[doc_id]


def test_a_changed_byte_is_found(spark, docs, tmp_path):
    folder = f"file:{tmp_path}/run"
    records.write_records(docs, folder)
    shard = sorted(tmp_path.glob("run/*.rec"))[0]
    data = bytearray(shard.read_bytes())
    data[40] ^= 1
    shard.write_bytes(bytes(data))
    with pytest.raises(Exception, match="BrokenRecord"):
        records.read_records(spark, folder).collect()


def test_records_of_nothing(no_docs, spark):
    assert records.round_trip(no_docs).count() == 0


def test_masked_checksums_frame_any_payload():
    data = records.frame(-5, np.array([1, 2, 70000]), np.dtype("<u4"))
    import io

    stream = io.BytesIO(data + data)
    for _ in range(2):
        doc_id, ids = records.unframe(stream.read)
        assert (doc_id, ids.tolist()) == (-5, [1, 2, 70000])
    assert records.unframe(stream.read) is None
    with pytest.raises(records.BrokenRecord):
        records.unframe(io.BytesIO(data[:-3]).read)


# -- packing ----------------------------------------------------------------------------


def test_every_id_lies_in_one_piece(docs, rows, encode):
    pieces = pack_documents(docs).collect()
    ids = {}
    for doc_id, text, *_ in rows:
        ids[doc_id] = encode(text)
    by_doc = {}
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == crc(ids[p.doc_id][p.start : p.start + p.length])
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
    for doc_id, cuts in by_doc.items():
        at = 0
        for start, length in sorted(cuts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[doc_id])
    assert set(by_doc) == set(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == parts[0].tier <= 1024 and at & (at - 1) == 0
    groups = Counter()
    for parts in sequences.values():
        groups[parts[0].step_group, parts[0].tier] += parts[0].tier
    assert max(groups.values()) <= 8 * 1024 and len({g for g, _ in groups}) == len(groups)


def test_packer_fills_whole_windows():
    rng = random.Random(1)
    packer = Packer(0, pool=50)
    total = 0
    for i in range(700):
        n = rng.choice([1, 5, 100, 128, 300, 511, 1024, 2500])
        packer.add(i, np.arange(n))
        total += n
    packer.finish()
    sizes = Counter({s: t for _, _, _, _, _, s, _, t, _ in packer.rows})
    assert sum(sizes.values()) == total == sum(r[2] for r in packer.rows)
    assert sum(t < 128 for t in sizes.values()) <= 7


def test_packing_of_nothing(no_docs):
    assert pack_documents(no_docs).count() == 0


def test_repeated_rows_are_packed_apart(spark, encode):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    got = pack_documents(docs)
    assert got.groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect() == [
        (None, 1),
        (1, 2 * len(encode("a b c"))),
    ]


# -- Order MinHash -------------------------------------------------------------------------


def test_order_minhash_equals_pairwise_calls(docs, rows):
    shape = Shape()
    ordered = sorted(rows, key=lambda r: r[0])
    got = {r.doc_id: r for r in order_minhash(docs).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        own, new, nxt = (fingerprint(t, shape) for t in (text, changed, following))
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == own.tobytes().hex() and r.edited_fingerprint == new.tobytes().hex()
        assert r.near_edited == float((own == new).mean()) and r.near_next == float((own == nxt).mean())


def test_likeness_follows_edits_and_order():
    rng = random.Random(2)
    words = [f"{rng.randrange(10**6):06d}" for _ in range(400)]
    text, shape = " ".join(words), Shape(tuples=256)
    like = lambda other: float((fingerprint(text, shape) == fingerprint(other, shape)).mean())
    assert like(text) == 1
    little, much = words[:], words[:]
    little[10:20], much[10:200] = ["x"] * 10, ["x"] * 190
    swapped = words[200:] + words[:200]
    assert like(" ".join(little)) > 0.8 > like(" ".join(much))
    # The same k-mers in another order are less alike than their set says.
    assert like(" ".join(swapped)) < 0.7
    assert like(" ".join(str(rng.random()) for _ in range(400))) < 0.1


def test_order_minhash_of_few_rows(spark, no_docs):
    assert order_minhash(no_docs).count() == 0
    one = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    row = order_minhash(one).collect()[0]
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert edited("abc", "zzz") == "abc"


# -- toxicity -------------------------------------------------------------------------------


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_toxicity_on_rows_held_out(spark):
    rng = random.Random(8)
    data = []
    for i in range(900):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(10, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["nasty", "Vile,", "gross"])
        data.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in data], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    test = [(i, y) for i, _, y in data if held_out(i)]
    assert all(got[i].held_out == held_out(i) for i, _, _ in data)
    assert sum(got[i].predicted == y for i, y in test) / len(test) > 0.97
    # Labels of rows held out change nothing.
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r for r in toxicity(docs, flipped).collect()}
    assert again == got


def test_toxicity_of_awkward_rows(docs, rows, no_docs, spark):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)], "doc_id long, toxic int")
    none = labels.where("false")
    out = toxicity(docs, labels, settings=Settings(epochs=1)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.score == 0.5 for r in toxicity(docs, none).collect())
    assert toxicity(no_docs, labels).count() == 0
