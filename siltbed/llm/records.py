"""Token sequences as length-delimited binary records with checksums and an offset index.

A shard is ``name.rec`` and ``name.idx``. The record file frames each document as

    length   8 bytes, little-endian, of the payload
    check    4 bytes, masked crc32 of the length bytes
    payload  document id (8), number of ids (4), bytes per id (4), then the ids
    check    4 bytes, masked crc32 of the payload

and the index holds the 8-byte offset of every record, so that a reader can fetch records
in any order. A manifest table names the shards of a run that count; files of failed or
repeated task attempts are in no manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltbed.llm.tokens import default_tokenizer, encoder, ids_crc32
from siltbed.llm.words import slices
from siltbed.sources.session import staging_path

LENGTH, CHECK, HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qII")
MASK_DELTA = 0xA282EAD8
NO_ID = -(1 << 63)

# Code points of a text in the keys that ranges are cut by.
KEY_CHARS = 64
MANIFEST = "part int, shard string, n_records long, n_tokens long, n_bytes long"


class BrokenRecord(ValueError):
    """A frame whose checksum or length does not hold."""


def masked_crc(data: bytes) -> int:
    """crc32, turned and moved so that checksums of data holding checksums stay sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int, ids: np.ndarray, dtype: np.dtype) -> bytes:
    payload = HEAD.pack(doc_id, len(ids), dtype.itemsize) + ids.astype(dtype).tobytes()
    length = LENGTH.pack(len(payload))
    return b"".join([length, CHECK.pack(masked_crc(length)), payload, CHECK.pack(masked_crc(payload))])


def index_entry(offset: int) -> bytes:
    return LENGTH.pack(offset)


def unframe(read) -> tuple[int, np.ndarray] | None:
    """The next document of a stream; None at its end."""
    head = read(LENGTH.size + CHECK.size)
    if not head:
        return None
    if len(head) < LENGTH.size + CHECK.size:
        raise BrokenRecord("cut off inside a length")
    length = head[: LENGTH.size]
    if CHECK.unpack(head[LENGTH.size :])[0] != masked_crc(length):
        raise BrokenRecord("length checksum")
    size = LENGTH.unpack(length)[0]
    body = read(size + CHECK.size)
    if len(body) < size + CHECK.size:
        raise BrokenRecord("cut off inside a payload")
    payload = body[:size]
    if CHECK.unpack(body[size:])[0] != masked_crc(payload):
        raise BrokenRecord("payload checksum")
    doc_id, n, width = HEAD.unpack(payload[: HEAD.size])
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=HEAD.size)
    if len(ids) != n:
        raise BrokenRecord("number of ids")
    return doc_id, ids


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path on it; ``file:/x`` is taken too."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode documents in ascending id order into record shards; returns their manifest.

    Documents are dealt to tasks by ranges of their id, so part numbers follow the ids and
    equal ids follow the text. Each task streams its rows into one shard under a name of
    its own; the manifest, written last, is what makes shards count. Null text counts as
    empty (its only token is the end id), a null id is written as the smallest number and
    comes first. Further columns are not read. An empty table has an empty manifest.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(path)
        dtype = id_type(encode.vocabulary)
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        rec = idx = None
        offset = records = tokens = 0
        for batch in slices(batches, 1):
            if rec is None:
                files, local = opened(name)
                files.create_dir(local.rpartition("/")[0], recursive=True)
                rec, idx = files.open_output_stream(f"{local}.rec"), files.open_output_stream(f"{local}.idx")
            ids, bounds = encode.encode(batch.column(1))
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                data = frame(NO_ID if doc_id is None else doc_id, ids[bounds[row] : bounds[row + 1]], dtype)
                rec.write(data)
                idx.write(index_entry(offset))
                offset += len(data)
                records += 1
            tokens += len(ids)
        if rec is not None:
            rec.close()
            idx.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "shard": name, "n_records": records, "n_tokens": tokens, "n_bytes": offset}],
                schema=pa.schema(
                    [
                        ("part", pa.int32()),
                        ("shard", pa.string()),
                        ("n_records", pa.int64()),
                        ("n_tokens", pa.int64()),
                        ("n_bytes", pa.int64()),
                    ]
                ),
            )

    # The driver samples the range keys, so texts take part by their beginning only; a range
    # holds all rows that share one, and the sort inside it compares whole texts.
    ranges = docs.select(id, text).repartitionByRange(F.col(id), F.substring(F.col(text), 1, KEY_CHARS))
    dealt = ranges.sortWithinPartitions(id, text)
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_record(shard: str, n: int) -> tuple[int, np.ndarray]:
    """The n-th document of a shard, found through the index: a read for a shuffled order."""
    files, local = opened(shard)
    with files.open_input_file(f"{local}.idx") as index:
        index.seek(n * LENGTH.size)
        offset = LENGTH.unpack(index.read(LENGTH.size))[0]
    with files.open_input_file(f"{local}.rec") as records:
        records.seek(offset)
        found = unframe(records.read)
    if found is None:
        raise BrokenRecord("no such record")
    return found


#: Tasks that read shards; beyond that many shards a task reads some.
MOST_READERS = 20_000


def read_records(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of a run, checked.

    ``start`` counts the ids of all documents before it. Shards are read by separate tasks
    and streamed, one document at a time in memory.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so the window over all of them is small.
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def shard_rows(shard: str, n_records: int, start: int) -> Iterator[dict]:
        files, local = opened(shard)
        read = 0
        with files.open_input_stream(f"{local}.rec", buffer_size=1 << 20) as stream:
            while (found := unframe(stream.read)) is not None:
                doc_id, ids = found
                row = {"doc_id": None if doc_id == NO_ID else doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": ids_crc32(ids)}
                if with_ids:
                    row["ids"] = ids.astype(np.int32)
                yield row
                start += len(ids)
                read += 1
        if read != n_records:
            raise BrokenRecord(f"{shard} has {read} records, the manifest says {n_records}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for found in shard_rows(row["shard"], row["n_records"], row["start"]):
                    rows.append(found)
                    if len(rows) == (256 if with_ids else 10_000):
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    # A task per shard: the number is given, as adaptive execution would put so small a table into one task.
    shards = max(1, min(manifest.count(), MOST_READERS))
    spread = placed.select("shard", "n_records", "start").repartitionByRange(shards, "start", "shard")
    return spread.mapInArrow(run, kinds)


def round_trip(docs: DataFrame, tokenizer: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write a record run into the checkpoint folder and read it back."""
    folder = staging_path(docs.sparkSession)
    write_records(docs, folder, tokenizer, id, text)
    return read_records(docs.sparkSession, folder)
