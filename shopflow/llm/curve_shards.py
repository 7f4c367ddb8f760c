"""Shards along a Hilbert curve over document metadata.

Each dimension (by default language, source and length) is quantised to ``2 ** BITS``
levels by the quantiles of all rows, the levels become a Hilbert curve index, and rows in
curve order are cut into runs: neighbours in several dimensions share a shard, so the
minimum and maximum of each dimension in a shard's file are close and a filter on any of
them skips most files. The law kept is ``rows``: shard sizes differ by one row at most.

Quantiles come from Spark's mergeable sketch over every row, so their size does not grow. A
text dimension is read as a number: the bytes after the longest prefix all values share.

Order within one curve cell is by a hash of the text, then doc_id. So equal texts in a cell
are neighbours, and a cell or a text with a third of all rows still spreads over the range
partitions. Ranks are position in the partition plus the rows in earlier ones, a table of
one row per partition. Texts are not shuffled: only ids, sizes and checksums are.

**Edge rows.** NULL values of a dimension come first, as the lowest level. NULL text: no
bytes, size 8, checksum 0. Rows under one doc_id, or without one, are rows like others.
Extra columns are not read. An empty table has no shards. With fewer rows than shards, the
first shards hold one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.session import stored

BITS = 6
ACCURACY = 2000
PREFIX_BYTES = 6  # 48 bits: exact in a double
OVERHEAD = 8
DIMENSIONS = ("lang", "source", "n_bytes")


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of ``levels`` (rows x dimensions, values below 2 ** bits),
    by Gray-code rotations from the highest bit plane down."""
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        lower = plane - 1
        for i in range(n):
            on = (x[i] & plane) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & lower)
            x[0] = np.where(on, x[0] ^ lower, x[0] ^ swap)
            x[i] ^= swap
        plane >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        flip = np.where((x[n - 1] & plane) != 0, flip ^ (plane - 1), flip)
        plane >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def _text_number(name: str, prefix: int) -> Column:
    """The bytes after the shared prefix, as a number that keeps the code-point order."""
    raw = F.rpad(F.hex(F.substring(F.encode(name, "UTF-8"), prefix + 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(raw, 16, 10).cast("double")


def _shared_prefix(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def in_curve_order(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, rank (0-based, gapless) and total, one row per row."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    slim = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
        *(F.col(d) if d != "n_bytes" else F.octet_length("text").alias("n_bytes") for d in dimensions),
    )
    slim = stored(slim, "curve-rows")
    kinds = dict(slim.dtypes)
    texts = [d for d in dimensions if kinds[d] == "string"]
    ends = slim.agg(F.lit(1), *(f(d) for d in texts for f in (F.min, F.max))).first()[1:]
    prefix = {d: _shared_prefix(*ends[2 * i : 2 * i + 2]) for i, d in enumerate(texts)}
    numbers = [_text_number(d, prefix[d]) if d in prefix else F.col(d).cast("double") for d in dimensions]
    numbered = slim.select(
        "doc_id", "size", "text_crc32", "text_hash", *(n.alias(f"d{i}") for i, n in enumerate(numbers))
    )
    steps = [q / 2**bits for q in range(1, 2**bits)]
    marks = numbered.agg(
        *(F.percentile_approx(f"d{i}", steps, ACCURACY) for i in range(len(numbers)))
    ).first()
    edges = [np.array(m or []) for m in marks]  # equal marks stay: levels follow the rows' shares

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = []
            for i, edge in enumerate(edges):
                value = batch.column(f"d{i}").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                levels.append(np.searchsorted(edge, value, side="right"))
            curve = hilbert_index(np.stack(levels, axis=1), bits)
            names = ["doc_id", "size", "text_crc32", "text_hash"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(curve, pa.int64())], names=[*names, "curve"]
            )

    order = [F.col("curve"), F.col("text_hash"), F.asc_nulls_first("doc_id")]
    ordered = (
        numbered.mapInArrow(index, "doc_id long, size long, text_crc32 long, text_hash long, curve long")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("at"))  # partition, then position
        .select("*", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
    )
    ordered = stored(ordered.drop("at", "text_hash"), "curve-order")
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy()).alias("total"),
    )
    return ordered.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", "curve", (F.col("before") + F.col("place")).alias("rank"), "total"
    )


def shards(docs: DataFrame, count: int = 24, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve of every row.

    The first (rows mod count) shards hold one row more than the others. ``slot`` is the
    place in the shard, in curve order.
    """
    small = F.floor(F.col("total") / count)
    more = F.col("total") % count
    edge = more * (small + 1)
    inside = F.col("rank") < edge
    shard = F.when(inside, F.floor(F.col("rank") / (small + 1))).otherwise(
        more + F.floor((F.col("rank") - edge) / F.greatest(small, F.lit(1)))
    )
    slot = F.when(inside, F.col("rank") % (small + 1)).otherwise(
        (F.col("rank") - edge) % F.greatest(small, F.lit(1))
    )
    return in_curve_order(docs, dimensions).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
