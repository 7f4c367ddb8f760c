"""Near-duplicate embeddings by an inverted multi-index with certified recall.

Vectors are compared by cosine only where labels (and sizes) are equal. Halves of the unit
vectors get a codebook each; a vector lives in the cell (i, j) of the product grid named by
its nearest codewords. A vector looks for partners by the multi-sequence traversal: the two
codebooks are sorted by a lower bound of the distance from the vector's half to anything in
a codeword's region, and cells come in ascending order of the two bounds' sum. Unit vectors
with cosine t lie within sqrt(2 - 2t), so the traversal may stop at the first cell whose sum
exceeds 2 - 2t: all partners are in cells before it. The target recall is therefore one.
Every pair found is verified by its cosine in double precision.

The bound: a region's points are nearer to its codeword c than to any other b, so the
distance from q to the region is at least (|q-c|^2 - |q-b|^2) / (2 |c-b|), for any b.

**Work and skew.** Equal vectors are folded to one with a count. A pair is looked for from
one side only, the smaller cell. A cell's residents and visitors are dealt to blocks of at
most ``BLOCK`` and ``VISITORS`` rows, so a cell that holds a third of all rows is many
tasks' work; a block compares by one matrix product and gives back link counts and the
edges of a spanning forest, never its pairs. Components are found on the edges.

More codewords mean fewer comparisons and more visits; a visit costs some hundred times a
comparison, so the codebooks grow slower than the square root of the vectors.

Codebooks are fitted on at most ``SAMPLE_PER_WORD * MOST_WORDS`` vectors, the first in hash
order; their size, and so what every task receives, is bounded by ``MOST_WORDS``. All
vectors are indexed, and the bound holds whatever the codebooks are.

**Edge rows.** NULL vectors or labels, NULL or non-finite components, zero or empty vectors:
no links, component is the row's own vec_id. NULL vec_id: no links, NULL component, not
kept. Rows repeated under one vec_id are vectors like others and link to each other. Vectors
of different sizes do not link. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopflow.session import stored

from .components import connected_components

SAMPLE_PER_WORD = 64
MOST_WORDS = 512
ROUNDS = 8
BLOCK = 1024
VISITORS = 4096
SLACK = 1e-9  # for rounding; the cosine itself decides


def usable(vector: str) -> Column:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _codebook(points: np.ndarray, words: int) -> np.ndarray:
    """Codewords by k-means from evenly spaced points; no randomness."""
    centres = points[np.linspace(0, len(points) - 1, words).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = _squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        used = counts > 0
        centres[used] = sums[used] / counts[used, None]
    return np.unique(centres, axis=0)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    made = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(made, 0)


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own codeword of each point, and squared lower bounds of the distance from each point
    to each codeword's region, from the point's nearest codewords."""
    far = _squared(points, centres)
    between = np.sqrt(_squared(centres, centres))
    near = np.argsort(far, axis=1, kind="stable")[:, : min(8, len(centres))]
    rows = np.arange(len(points))
    bound = np.zeros_like(far)
    for k in range(near.shape[1]):
        b = near[:, k]
        gap = far - far[rows, b][:, None]
        apart = between[b]
        with np.errstate(divide="ignore", invalid="ignore"):
            one = np.where(apart > 0, gap / (2 * apart), 0.0)
        np.maximum(bound, one, out=bound)
    return near[:, 0], bound * bound


def multi_sequence(first: np.ndarray, second: np.ndarray, stop: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in ascending order of first[i] + second[j], up to ``stop``."""
    a, b = (np.argsort(v, kind="stable") for v in (first, second))
    a, b = a[first[a] <= stop], b[second[b] <= stop]
    if not len(a) or not len(b):
        return
    waiting = [(first[a[0]] + second[b[0]], 0, 0)]
    while waiting:
        total, i, j = heapq.heappop(waiting)
        if total > stop:
            return
        yield int(a[i]), int(b[j])
        if j + 1 < len(b):  # each cell has one parent: its left neighbour, or the row above
            heapq.heappush(waiting, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(waiting, (first[a[i + 1]] + second[b[0]], i + 1, 0))


def _unit(column: pa.Array, width: int) -> np.ndarray:
    """Rows of unit vectors in double precision, padded with zeros to one width."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the norm
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


VISITS = "label long, size int, cell long, visitor boolean, node long, many long, vector array<double>"


def _visits(nodes: DataFrame, width: int, halves: list[np.ndarray], stop: float) -> DataFrame:
    """Each vector in its own cell, and as a visitor in later cells that can hold partners."""
    half = width // 2
    across = len(halves[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), 2048):
                batch = whole.slice(low, 2048)
                units = _unit(pa.array(batch.column("vector")), width)
                own1, bound1 = bounds(units[:, :half], halves[0])
                own2, bound2 = bounds(units[:, half:], halves[1])
                own = own1 * across + own2
                at, cell = [], []
                for row in range(len(units)):
                    for i, j in multi_sequence(bound1[row], bound2[row], stop):
                        if i * across + j > own[row]:
                            at.append(row)
                            cell.append(i * across + j)
                everyone = np.concatenate([np.arange(len(units)), np.array(at, np.int64)]).astype(np.int64)
                cells = np.concatenate([own, np.array(cell, np.int64)]).astype(np.int64)
                taken = batch.take(pa.array(everyone))
                vectors = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(everyone) + 1) * width, pa.int32()), pa.array(units[everyone].ravel())
                )
                visitor = np.arange(len(everyone)) >= len(units)
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("label"),
                        taken.column("size"),
                        pa.array(cells),
                        pa.array(visitor),
                        taken.column("node"),
                        taken.column("many"),
                        vectors,
                    ],
                    names=["label", "size", "cell", "visitor", "node", "many", "vector"],
                )

    return nodes.mapInArrow(run, VISITS)


FOUND = "a long, b long, links long"


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        node, many = table.column("node").to_numpy(), table.column("many").to_numpy()
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(role), -1)
        home = np.flatnonzero(role == 0)
        others = np.flatnonzero(role == 1)
        inside = bool(table.column("inside")[0].as_py())
        right = np.concatenate([home, others]) if inside else others
        linked = vectors[home] @ vectors[right].T >= threshold
        if inside:
            linked[np.arange(len(home)), np.arange(len(home))] = False
        counts = np.zeros(len(role), np.int64)
        i, j = np.nonzero(linked)
        np.add.at(counts, home[i], many[right[j]])
        foreign = j >= len(right) - len(others)
        np.add.at(counts, right[j[foreign]], many[home[i[foreign]]])
        # components of the block's links, by spreading minima
        name = np.arange(len(role))
        while len(i):
            before = name.copy()
            np.minimum.at(name, home[i], name[right[j]])
            np.minimum.at(name, right[j], name[home[i]])
            name = name[name]
            if (name == before).all():
                break
        root = node[name]
        some = (counts > 0) | (root != node)
        return pa.table(
            [pa.array(node[some]), pa.array(root[some]), pa.array(counts[some])], names=["a", "b", "links"]
        )

    return run


def _blocks(visits: DataFrame) -> DataFrame:
    """Deal each cell's rows to blocks: residents to one, visitors to all; both by hash."""
    cell = ["label", "size", "cell"]
    sizes = visits.groupBy(*cell).agg(
        F.ceil(F.count_if(~F.col("visitor")) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.count_if(F.col("visitor")) / VISITORS).cast("int").alias("queues"),
        F.count_if(~F.col("visitor")).alias("residents"),
        F.count(F.lit(1)).alias("rows"),
    )
    # stored, so that the join below has plain inputs and a hot cell can be split
    sizes = stored(sizes.where("residents > 0 and rows > 1"), "embedding-cells")
    sized = visits.join(sizes, cell)
    home = F.pmod(F.xxhash64("node"), F.col("homes")).cast("int")
    queue = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest("queues", F.lit(1))).cast("int")
    all_homes = F.sequence(F.lit(0), F.col("homes") - 1)
    all_queues = F.sequence(F.lit(0), F.greatest("queues", F.lit(1)) - 1)

    def place(homes: Column, queues: Column, role: int) -> Column:
        return F.struct(homes.alias("home"), queues.alias("queue"), F.lit(role).alias("role"))

    zero = F.lit(0)
    # a resident: in its own block with each queue of visitors; and, as a visitor of the
    # later blocks of its cell, in a queue of its own, numbered from -1 down by block
    resident = F.concat(
        F.transform(all_queues, lambda q: place(home, q, 0)),
        F.transform(all_homes, lambda h: place(h, -1 - home, 1)),
        F.transform(all_homes, lambda h: place(home, -1 - h, 0)),
    )
    resident = F.filter(
        resident,
        lambda p: (p["queue"] >= zero)
        | ((p["role"] == 1) & (p["home"] > home))
        | ((p["role"] == 0) & (-1 - p["queue"] < home)),
    )
    visitor = F.transform(all_homes, lambda h: place(h, queue, 1))
    placed = sized.select(
        *cell, "node", "many", "vector", F.explode(F.when(F.col("visitor"), visitor).otherwise(resident)).alias("p")
    )
    return placed.select(*cell, "node", "many", "vector", "p.*", (F.col("p.queue") == 0).alias("inside"))


def near_duplicates(rows: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    raw = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").alias("vector")
    )
    valid = usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    marked = raw.withColumn("vector", F.when(valid, F.col("vector")))
    nodes = stored(
        marked.where("vector is not null")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("many"))
        .withColumn("size", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id()),  # fixed by being stored
        "embedding-nodes",
    )
    shape = nodes.agg(F.max("size"), F.count(F.lit(1))).first()
    width, total = shape[0] or 1, shape[1]
    words = int(min(MOST_WORDS, max(4, (total / 1000) ** 0.54)))
    sample = nodes.orderBy(F.xxhash64("vector")).limit(SAMPLE_PER_WORD * words).select("vector").toArrow()
    half = width // 2
    if len(sample):
        units = _unit(sample.column("vector").combine_chunks(), width)
        halves = [_codebook(units[:, :half], words), _codebook(units[:, half:], words)]
    else:
        halves = [np.zeros((1, half)), np.zeros((1, width - half))]
    visits = stored(_visits(nodes, width, halves, 2 - 2 * threshold + SLACK), "embedding-visits")
    found = stored(
        _blocks(visits)
        .groupBy("label", "size", "cell", "home", "queue")
        .applyInArrow(_compare(threshold), FOUND),
        "embedding-links",
    )
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    components = connected_components(found.select("a", "b"))
    # a component is named by its least vec_id, which its least node need not have
    placed = stored(
        nodes.select("label", "vector", "node", "many", "least")
        .join(links, "node", "left")
        .join(components, "node", "left"),
        "embedding-placed",
    )
    names = stored(
        placed.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("name")), "embedding-names"
    )
    named = placed.join(names, "component", "left").select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
        F.coalesce("name", "least").alias("name"),
    )
    component = F.coalesce("name", "vec_id")
    return marked.join(named, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
