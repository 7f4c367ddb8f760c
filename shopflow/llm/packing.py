"""Packing documents into training sequences of equal attention cost.

A sequence takes at most ``length`` tokens. Its cost is estimated as LINEAR * n +
QUADRATIC * n * n, summed over its pieces: attention is quadratic inside a document and
masked between documents.

A document longer than a sequence first fills whole sequences of its own; only its tail
(shorter than a sequence) is packed with others. Tails are dealt by a hash of the row's place
to buckets of a bounded size, and each bucket is packed by itself: as many sequences as its
tokens need at least, the tails in descending order, each into the sequence of lowest cost
that has room for it. A tail for which no sequence has room is cut: it fills the cheapest
open sequence, and the rest of it goes back into the order. So only the last sequence of a
bucket is not full: with ``BUCKET_BYTES`` of text in a bucket, far less than one percent of
the tokens are padding.

A bucket is dealt by row, so a hot source is spread evenly, and so are the rows of one id or
one text. Ids travel only for tails; the checksums of whole sequences are made where the text
is tokenized. The dealt pieces are stored before they are grouped: a place is given once, and
a lost executor costs a re-read.

**Edge rows.** A NULL or empty text is a document of one token, the end id. Rows repeated
under one doc_id are packed as documents of their own. NULL doc_ids are packed like others.
Other columns are not read. An empty table gives no sequences.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.session import stored

from .tokens import encoder

LENGTH = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
BUCKET_BYTES = 2 << 20
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, cost double"
)


def cost(length: int) -> float:
    """Estimated work of attention and of everything else over one piece."""
    return LINEAR * length + QUADRATIC * length * length


def plan(lengths: list[int], room: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) pieces, in as few sequences as the tokens need."""
    count = -(-sum(lengths) // room)
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    costs, free = np.zeros(count), np.full(count, room)
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]  # longest first
    heapq.heapify(waiting)
    while waiting:
        size, item, start = heapq.heappop(waiting)
        size = -size
        fits = np.flatnonzero(free >= size)
        if not len(fits):
            fits = np.flatnonzero(free > 0)
        chosen = int(fits[costs[fits].argmin()])
        taken = min(size, int(free[chosen]))
        sequences[chosen].append((item, start, taken))
        free[chosen] -= taken
        costs[chosen] += cost(taken)
        if taken < size:
            heapq.heappush(waiting, (taken - size, item, start + taken))
    return sequences


def pieces(docs: DataFrame, tokenizer: str, length: int, buckets: int) -> DataFrame:
    """Whole sequences (with their checksums) and tails (with their ids), dealt to buckets."""
    slim = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).alias("bucket"),
    )
    names = ["bucket", "doc_id", "doc_tokens", "start", "length", "crc", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        width = tokens.dtype.itemsize
        for batch in batches:
            for some, made in tokens.encode_batch(batch):
                rows = []
                for doc_id, home, packed in zip(*(some.column(c).to_pylist() for c in ("doc_id", "bucket")), made):
                    n = len(packed) // width
                    full = n // length * length
                    if full:
                        wide = np.frombuffer(packed, tokens.dtype, full).astype("<u4")
                        for s in range(0, full, length):
                            rows.append((home, doc_id, n, s, length, zlib.crc32(wide[s : s + length]), None))
                    if full < n:
                        rows.append((home, doc_id, n, full, n - full, None, packed[full * width :]))
                columns = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return slim.mapInArrow(
        cut, "bucket long, doc_id long, doc_tokens long, start long, length long, crc long, ids binary"
    )


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and the estimated cost of the piece. Offsets are gapless within a sequence."""
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    cut = stored(pieces(docs, tokenizer, length, buckets), "packing-pieces")

    def fill(table: pa.Table) -> pa.Table:
        dtype = encoder(tokenizer).dtype
        rows = sorted(
            table.to_pylist(),
            key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["length"], r["ids"] or b""),
        )
        base = rows[0]["bucket"] << 32
        made = []
        tails = [r for r in rows if r["crc"] is None]
        for number, r in enumerate(r for r in rows if r["crc"] is not None):
            made.append((r["doc_id"], r["start"], length, r["crc"], r["doc_tokens"], base + number, 0, cost(length)))
        base += len(made)
        for number, sequence in enumerate(plan([r["length"] for r in tails], length)):
            offset = 0
            for item, start, taken in sequence:
                r = tails[item]
                ids = np.frombuffer(r["ids"], dtype)[start : start + taken].astype("<u4")
                made.append(
                    (
                        r["doc_id"],
                        r["start"] + start,
                        taken,
                        zlib.crc32(ids),
                        r["doc_tokens"],
                        base + number,
                        offset,
                        cost(taken),
                    )
                )
                offset += taken
        names = [part.split()[0] for part in PIECES.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    return cut.groupBy("bucket").applyInArrow(fill, PIECES)
