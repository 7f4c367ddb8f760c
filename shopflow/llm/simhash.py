"""SimHash near-duplicates, candidates filtered by pigeonring chains.

A text's words, A-Z lower-cased, make 3-word shingles (all of them, repeats included). A
fingerprint bit is set when more than half of the shingles' XXH64 values have it. Two
fingerprints link when at most ``max_bits`` of the 64 bits differ.

**Candidates.** The 64 bits are a ring of ``SEGMENTS`` segments. If two fingerprints differ
in at most k bits, some start exists from which every chain of l consecutive segments
differs in at most l * k / SEGMENTS bits. With k = 2 and five segments the budgets are
0, 0, 1, 1, 2: two neighbouring segments (25 or 26 bits) are equal, and that pair is the
key of an equality grouping, five keys per fingerprint. Inside a group the longer chains
are checked one after the other; only what passes gets the full Hamming check.

**Skew.** Equal fingerprints are folded to one before anything else. A group with more than
``GROUP_LIMIT`` fingerprints, as one made by a third of all rows being near copies, goes
another exact way (for k = 2): each of its fingerprints also names its one-bit neighbours,
and fingerprints that name the same value differ in at most two bits. This takes one
grouped minimum, combined before its shuffle, and no pairs. Groups emit the edges of a
spanning forest, at most one per member, never all pairs.

**Edge rows.** NULL and empty texts, and texts without a word, have fingerprint zero and
link like any other. Fewer than three words: the whole sequence is the one shingle. Rows
with a NULL doc_id get a fingerprint, keep NULL as component when no row with an id is
linked to them, and never name a component. Repeated rows are kept, each with the same
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopflow.session import stored

from .components import connected_components
from .texts import row_key

SHINGLE = 3
SEED = 42
SEGMENTS = 5
GROUP_LIMIT = 1024


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    found = text.lower().split() if text else []  # bytes: ASCII letters, ASCII white space
    if not found:
        return 0
    shingles = [b" ".join(found)] if len(found) < shingle else map(
        b" ".join, zip(*(found[i:] for i in range(shingle)))
    )
    digest = xxhash.xxh64_digest  # big-endian bytes
    hashes = b"".join([digest(s, SEED) for s in shingles])
    ones = np.zeros(64, np.int64)
    step = 8 * (1 << 16)  # a bounded slice at a time
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(np.frombuffer(hashes[at : at + step], np.uint8))
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    majority = ones * 2 > len(hashes) // 8
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, row_key) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            made = [signed(fingerprint(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.int64()), batch.column("row_key")],
                names=["doc_id", "fp", "row_key"],
            )

    slim = docs.select(F.col("doc_id").cast("long"), "text", row_key().alias("row_key"))
    return slim.mapInArrow(run, "doc_id long, fp long, row_key string")


def segment_bounds(segments: int) -> list[int]:
    return [64 * i // segments for i in range(segments + 1)]


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    if not by:
        return values
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def _linked(values: np.ndarray, start: int, segments: int, max_bits: int) -> np.ndarray:
    """Pairs (i < j) of values that keep every chain budget from segment ``start`` on."""
    bounds = segment_bounds(segments)
    turned = _rotated(values, bounds[start])  # the chain now begins at the highest bit
    widths = [
        bounds[(start + i) % segments + 1] - bounds[(start + i) % segments] for i in range(segments)
    ]
    i, j = np.triu_indices(len(values), 1)
    differ = turned[i] ^ turned[j]
    length = 0
    for chain, width in enumerate(widths, 1):
        length += width
        budget = chain * max_bits // segments
        seen = differ >> np.uint64(64 - length) if length < 64 else differ
        passed = np.bitwise_count(seen) <= budget
        i, j, differ = i[passed], j[passed], differ[passed]
    return np.stack([i, j], axis=1)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges (node, root) of the components that the pairs form over 0..n-1."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in range(n) if root(x) != x]


def edges(fps: DataFrame, max_bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """(a, b) edges that connect distinct fingerprints as the links do; ``fps`` holds the
    distinct ``fp`` with the ``node`` to name in edges."""
    equal = max(c for c in range(1, segments + 1) if c * max_bits // segments == 0)
    bounds = segment_bounds(segments)
    keys = []
    for start in range(segments):
        width = bounds[min(start + equal, segments)] - bounds[start]
        width += bounds[max(0, start + equal - segments)]
        # the chain's bits, turned to the low end
        turn = (bounds[start] + width) % 64
        left, right = F.shiftleft("fp", turn), F.shiftrightunsigned("fp", 64 - turn)
        turned = left.bitwiseOR(right) if turn else F.col("fp")
        chain = turned.bitwiseAND(F.lit((1 << width) - 1))
        keys.append(F.struct(F.lit(start).alias("start"), chain.alias("chain")))
    keyed = fps.select("fp", "node", F.explode(F.array(*keys)).alias("k")).select("k.*", "fp", "node")
    sizes = keyed.groupBy("start", "chain").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = stored(sizes, "simhash-sizes")  # the join's large groups can then be split
    grouped = stored(keyed.join(sizes, ["start", "chain"]), "simhash-chains")

    def within(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().view(np.uint64)
        nodes = group["node"].to_numpy()
        order = np.argsort(nodes)
        values, nodes = values[order], nodes[order]
        pairs = _linked(values, int(group["start"].iloc[0]), segments, max_bits)
        made = _forest(pairs, len(values))
        return pd.DataFrame(
            {"a": nodes[[a for a, _ in made]], "b": nodes[[b for _, b in made]]}, dtype="int64"
        )

    if max_bits != 2:  # the two-bit shortcut below does not hold: all groups the plain way
        return grouped.groupBy("start", "chain").applyInPandas(within, "a long, b long")
    # comparing is work, not bytes: adaptive execution would merge the groups into few tasks
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = grouped.where(F.col("members") <= GROUP_LIMIT).repartition(tasks, "start", "chain")
    paired = small.groupBy("start", "chain").applyInPandas(within, "a long, b long")

    flips = [F.lit(0).cast("long"), *(F.lit(signed(1 << b)) for b in range(64))]
    large = grouped.where(F.col("members") > GROUP_LIMIT).select("fp", "node").distinct()
    named = large.select("node", F.explode(F.array(*flips)).alias("flip"), "fp").select(
        "node", F.col("fp").bitwiseXOR(F.col("flip")).alias("named")
    )
    least = named.groupBy("named").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n"))
    met = named.join(least.where("n > 1"), "named").where("node <> b")
    return paired.union(met.select(F.col("node").alias("a"), "b").distinct())


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, row_key, group, component_id) of every row of ``docs``; ``group`` is a
    fingerprint of the row's component, ``component_id`` its smallest doc_id."""
    rows = stored(fingerprints(docs), "simhash-rows")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(edges(fps.select("fp", F.col("fp").alias("node"))))
    named = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "group").drop("least"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every row of ``docs``."""
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return neighbours(docs).select("doc_id", text.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of each group, all columns unchanged.

    Ties (rows repeated under one doc_id) are broken by the row key; of wholly equal rows
    one stays. A group without any doc_id keeps one row as well.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    keep = neighbours(docs).groupBy("group").agg(first).select(F.col("first.row_key").alias("k"))
    whole = docs.select(F.struct("*").alias("row"), row_key().alias("k"))
    return whole.join(keep, "k").groupBy("k").agg(F.first("row").alias("row")).select("row.*")
