"""Token-id files in patched frame-of-reference blocks.

``write`` tokenizes whole texts in ascending doc_id order and stores them as chunks, one
row each, in Parquet files that Spark's own committer publishes: a lost executor's task is
run again and a reader never sees half of it. ``read`` gives back every document's ids.

A chunk holds whole documents. Its payload is

    "PFR1" | ids u32 | blocks u32 | index: start of each block, u32 | blocks

and a block of ``BLOCK`` ids is

    minimum u32 | width u8 | exceptions u16 | positions u8 each | high parts u32 each | packed

An id is kept as its distance from the block's minimum. The width is that of the distance
at the ``PERCENTILE`` point, so a few outliers do not widen a whole block: their low bits
are packed as the others', their high bits stand in the exception list. The block index
lets a reader decode a range of ids without the blocks before it.

The rows around the payload name the documents and their lengths, the range partition the
chunk belongs to, and the ids before it there. Partitions are in doc_id order, so a running
total over one row per partition turns these into global starts.

**Edge rows.** A NULL or empty text is the end id alone. NULL doc_ids come first; rows
under one doc_id follow each other in the order of their texts' hashes. Other columns are
not read. An empty table gives an empty file table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopflow.session import discard, fresh_path, stored

from .texts import with_columns
from .tokens import encoder

BLOCK = 256
PERCENTILE = 90
CHUNK_IDS = 1 << 17
_HEAD = struct.Struct("<4sII")
_BLOCK_HEAD = struct.Struct("<IBH")
_BLOCK_TYPE = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "<u2")])  # the same, packed

CHUNKS = "part int, first long, n_ids long, doc_ids array<long>, lengths array<int>, payload binary"


def _container(width: int) -> np.dtype:
    """The smallest unsigned type with ``width`` bits."""
    return np.dtype("<u1" if width <= 8 else "<u2" if width <= 16 else "<u4")


def _packed_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every value, one row of bytes per row of values."""
    kind = _container(width)
    raw = values.astype(kind).view(np.uint8)  # the cast keeps the low bits
    if width == 8 * kind.itemsize:
        return raw
    bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(values), BLOCK, -1)
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def _unpacked_bits(packed: np.ndarray, width: int) -> np.ndarray:
    """The values of ``_packed_bits``."""
    kind = _container(width)
    if width == 8 * kind.itemsize:
        return np.ascontiguousarray(packed).view(kind)
    bits = np.zeros((len(packed), BLOCK, 8 * kind.itemsize), np.uint8)
    if width:
        bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, BLOCK, width)
    return np.packbits(bits.reshape(len(packed), -1), axis=1, bitorder="little").view(kind)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def pack(ids: np.ndarray) -> bytes:
    """The payload for a sequence of ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return _HEAD.pack(b"PFR1", 0, 0)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    padded[n:] = ids[-1]
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    away = grid - least[:, None]
    at = (BLOCK - 1) * PERCENTILE // 100
    typical = np.partition(away, at, axis=1)[:, at]
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    high = (away.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype("<u4")
    block, position = np.nonzero(high)
    exceptions = np.bincount(block, minlength=blocks)
    sizes = _BLOCK_HEAD.size + 5 * exceptions + width * (BLOCK // 8)
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    head = np.zeros(blocks, _BLOCK_TYPE)
    head["least"], head["width"], head["exceptions"] = least, width, exceptions
    out[starts[:, None] + np.arange(_BLOCK_HEAD.size)] = head.view(np.uint8).reshape(blocks, -1)
    place = starts + _BLOCK_HEAD.size
    out[_spread(place, exceptions)] = position
    out[_spread(place + exceptions, 4 * exceptions)] = high[block, position].view(np.uint8)
    place += 5 * exceptions
    for w in np.unique(width).tolist():
        chosen = np.flatnonzero(width == w)
        out[place[chosen, None] + np.arange(w * BLOCK // 8)] = _packed_bits(away[chosen], w)
    return _HEAD.pack(b"PFR1", n, blocks) + starts.astype("<u4").tobytes() + out.tobytes()


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids ``first`` to ``last`` (exclusive) of a payload; only their blocks are read."""
    magic, n, blocks = _HEAD.unpack_from(payload)
    if magic != b"PFR1":
        raise ValueError("not a token chunk")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    body = _HEAD.size + 4 * blocks
    low, high = first // BLOCK, -(-last // BLOCK)
    place = body + np.frombuffer(payload, "<u4", high - low, _HEAD.size + 4 * low).astype(np.int64)
    whole = np.frombuffer(payload, np.uint8)
    head = whole[place[:, None] + np.arange(_BLOCK_HEAD.size)].view(_BLOCK_TYPE).reshape(-1)
    least, widths = head["least"], head["width"]
    exceptions = head["exceptions"].astype(np.int64)
    place += _BLOCK_HEAD.size
    out = np.empty((high - low, BLOCK), np.uint32)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        at = place[rows] + 5 * exceptions[rows]
        out[rows] = _unpacked_bits(whole[at[:, None] + np.arange(width * BLOCK // 8)], width)
    rows = np.repeat(np.arange(high - low), exceptions)
    more = whole[_spread(place + exceptions, 4 * exceptions)].view("<u4").astype(np.uint64)
    out[rows, whole[_spread(place, exceptions)]] |= (more << widths[rows].astype(np.uint64)).astype(np.uint32)
    out += least[:, None]
    return out.reshape(-1)[first - low * BLOCK : last - low * BLOCK]


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text_hash, place, n, ids) of every row; ``place`` tells equal rows apart."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in batches:
            for some, made in tokens.encode_batch(batch):
                ids = pa.array(made, pa.binary())
                n = pc.divide(pc.binary_length(ids), pa.scalar(tokens.dtype.itemsize, pa.int32()))
                yield with_columns(some, ["doc_id", "text_hash", "place"], {"n": n, "ids": ids})

    slim = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("place"),
        "text",
    )
    return slim.mapInArrow(encode, "doc_id long, text_hash long, place long, n int, ids binary")


def in_order(ids: DataFrame) -> DataFrame:
    """Tokenized rows range-partitioned by doc_id; rows under one id, or none, are split too."""
    order = [F.asc_nulls_first("doc_id"), F.col("text_hash"), F.col("place")]
    return ids.repartitionByRange(*order).sortWithinPartitions(*order)


def write(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the chunks as Parquet files under ``path``.

    Texts are tokenized where they are read. Their ids are stored before the range
    partitioning: its sample, and reducers that are run again, read the files.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first, size, ids, names, lengths = 0, 0, [], [], []

        def chunk() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), f"<u{sum(map(len, ids)) // size}")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([pack(flat)], pa.binary()),
                ],
                names=["part", "first", "n_ids", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "n", "ids"))
            for doc_id, n, packed in zip(*(c.to_pylist() for c in columns)):
                ids.append(packed)
                names.append(doc_id)
                lengths.append(n)
                size += n
                if size >= CHUNK_IDS:
                    yield chunk()
                    first, size, ids, names, lengths = first + size, 0, [], [], []
        if ids:
            yield chunk()

    ids = stored(tokenized(docs, tokenizer), "token-ids")
    in_order(ids).select("doc_id", "n", "ids").mapInArrow(chunks, CHUNKS).write.parquet(path)
    discard(ids)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("size"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))

    offsets = stored(offsets, "token-offsets")  # tiny: the chunks need no shuffle to meet it

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).astype("<u4")
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = ends - np.array(row["lengths"], np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["offset"] + row["first"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = chunks.join(offsets, "part").select("offset", "first", "doc_ids", "lengths", "payload")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = fresh_path(docs.sparkSession, "token-files")
    write(docs, tokenizer, path)
    return read(docs.sparkSession, path)
