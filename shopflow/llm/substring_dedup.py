"""Removal of passages that an earlier document holds, by suffix automata of shards.

A window is ``WINDOW`` consecutive words of one document. Every word covered by a window
whose word sequence also starts in a document with a smaller doc_id goes. Windows are
judged on the input, so what is removed elsewhere does not matter.

**Shards.** Any equal windows have the same anchor: the ``ANCHOR`` words with the least
hash in the window, the leftmost such. A document is cut into segments, each the run of
windows with one anchor, and only anchors found in two documents matter. Equal segments
are folded to one, with the smallest doc_id. Segments are dealt to reference shards by
anchor; a shard's suffix automaton is built over its distinct segments and carries, for
every state, the smallest doc_id whose text reaches it. The segments then stream through
their shard's automaton for matching statistics: where the match is at least a window long,
the state of that window's length gives the smallest document with the window, and runs of
such windows give the maximal spans to remove.

An automaton is not sent to every executor, since the reference grows with the corpus; it
goes only where segments can match it, so its size is bounded by ``SHARD_SEGMENTS``.

**Skew.** An anchor with more distinct segments than that (a group of near copies with
edits all over) is cut again by longer anchors inside its windows, ``FINER`` words long in
turn. The last is a whole window, where equal segments leave one row per anchor, so no
group stays large. Minima are combined before their shuffles, and the joins back to the
documents are equi joins that adaptive execution may split. Exact copies of a whole text
are settled by a hash of their words, before segments are made.

**Edge rows.** NULL text: no words. Fewer words than a window: nothing goes. A NULL doc_id
is larger than all others: such a row loses what any document with an id holds and takes
nothing from others (so does the largest possible id, which stands for NULL inside). Rows under one doc_id take nothing from each other; every row has a
result of its own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopflow.session import discard, release, stored

WINDOW = 50
ANCHOR = 10
FINER = (30, WINDOW)
SHARD_SEGMENTS = 1500
CACHE_ENTRIES = 500_000
NOBODY = (1 << 63) - 1  # stands for a NULL doc_id: smaller than no document

# a row is known by ``me``, its doc_id or NOBODY, and ``text_key``, a hash of its text
KEY = ["me", "text_key"]
ROWS = (
    "doc_id long, me long, text_key long, n_words long, sha string, "
    "anchors array<struct<anchor:long,first:int,last:int>>"
)
SEGMENTS = "anchor long, segment string, first int, me long, text_key long"


class _Hashes(dict):
    """A word's 64-bit hash; what was seen is kept, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh64_intdigest(word)
        if len(self) > CACHE_ENTRIES:
            self.clear()
        self[word] = made
        return made


_HASHES = _Hashes()


def anchors(hashes: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, end of windows) of every run of windows with one anchor."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - size + 1 + k]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1)
    at = np.empty(len(views), np.int64)
    for low in range(0, len(views), 1 << 16):  # long texts in slices
        at[low : low + (1 << 16)] = views[low : low + (1 << 16)].argmin(axis=1)
    at += np.arange(len(views))
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.append(starts[1:], len(at))
    return grams[at[starts]], starts, ends


def _hashed(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))


def _words(batch: pa.RecordBatch, column: str = "text") -> Iterator[list[bytes]]:
    for text in batch.column(column).cast(pa.binary()):
        value = text.as_py()
        yield value.split() if value else []  # bytes split at ASCII white space only


def _scan(docs: DataFrame) -> DataFrame:
    """One row per document: its length, a hash of its words and its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, runs = [], [], []
            for found in _words(batch):
                counts.append(len(found))
                shas.append(hashlib.sha256(b" ".join(found)).hexdigest())
                runs.append(anchors(_hashed(found), ANCHOR, WINDOW) if len(found) >= WINDOW else None)
            made = [r for r in runs if r is not None]
            offsets = np.cumsum([0] + [0 if r is None else len(r[0]) for r in runs])
            flat = [np.concatenate([r[i] for r in made]) if made else np.zeros(0) for i in range(3)]
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(flat[0].astype(np.uint64).view(np.int64)),
                    pa.array(flat[1].astype(np.int32)),
                    pa.array(flat[2].astype(np.int32)),
                ],
                names=["anchor", "first", "last"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", *KEY)),
                    pa.array(counts, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries),
                ],
                names=["doc_id", *KEY, "n_words", "sha", "anchors"],
            )

    return docs.mapInArrow(run, ROWS)


def _segments(shared: DataFrame) -> DataFrame:
    """Segments of the documents around anchors that other documents have as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.select([*KEY, "runs"]).to_pydict()
            made = []
            for found, me, key, runs in zip(_words(batch), *columns.values()):
                for r in runs:
                    text = b" ".join(found[r["first"] : r["last"] + WINDOW - 1])
                    made.append((r["anchor"], text, r["first"], me, key))
            yield _segment_batch(made)

    return shared.mapInArrow(run, SEGMENTS)


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    segment = pa.array(columns[1], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], pa.int64()),
            segment,
            pa.array(columns[2], pa.int32()),
            pa.array(columns[3], pa.int64()),
            pa.array(columns[4], pa.int64()),
        ],
        names=["anchor", "segment", "first", *KEY],
    )


def _cut_again(segments: DataFrame, size: int) -> DataFrame:
    """The same windows in shorter segments, by anchors of ``size`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.select(["anchor", "first", *KEY]).to_pydict()
            made = []
            for found, anchor, first, me, key in zip(_words(batch, "segment"), *columns.values()):
                for h, low, high in zip(*anchors(_hashed(found), size, WINDOW)):
                    mixed = (int(h) ^ (anchor * 0x9E3779B97F4A7C15)) & ((1 << 64) - 1)
                    text = b" ".join(found[low : high + WINDOW - 1])
                    made.append((mixed - (1 << 63), text, first + int(low), me, key))
            yield _segment_batch(made)

    return segments.mapInArrow(run, SEGMENTS)


class SuffixAutomaton:
    """Suffix automaton of several word sequences; a state knows its smallest owner."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner = [NOBODY]

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(NOBODY)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, word: int) -> int:
        """Split the sequences of length[p] + 1 off state q."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int], owner: int) -> None:
        last = 0
        for word in words:
            p, q = last, self.next[last].get(word)
            if q is not None:  # an earlier sequence already reaches it
                last = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
            else:
                last = self._state(self.length[p] + 1, {}, 0)
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    exact = self.length[q] == self.length[p] + 1
                    self.link[last] = q if exact else self._clone(p, q, word)
            if owner < self.owner[last]:
                self.owner[last] = owner

    def settle(self) -> None:
        """Pass each state's owner on to the states of its suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            link = self.link[state]
            if self.owner[state] < self.owner[link]:
                self.owner[link] = self.owner[state]

    def owners(self, words: list[int], window: int) -> list[int]:
        """The smallest owner of the window that ends at each word, NOBODY without a match."""
        state, matched, made = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            at = state
            if matched >= window:
                while self.length[self.link[at]] >= window:
                    at = self.link[at]
                made.append(self.owner[at])
            else:
                made.append(NOBODY)
        return made


FOUND = "segment_key binary, runs array<struct<at:int,windows:int,owner:long>>"


def _judge(table: pa.Table) -> pa.Table:
    """Build the automaton of one shard and stream the shard's segments through it."""
    ids: dict[bytes, int] = {}
    texts = table.column("segment").cast(pa.binary()).to_pylist()
    sequences = [[ids.setdefault(w, len(ids)) for w in text.split()] for text in texts]
    automaton = SuffixAutomaton()
    for words, owner in zip(sequences, table.column("owner").to_pylist()):
        automaton.add(words, owner)
    automaton.settle()
    made = []
    for words in sequences:
        runs: list[dict] = []
        for at, owner in enumerate(automaton.owners(words, WINDOW)[WINDOW - 1 :]):
            if owner == NOBODY:
                continue
            if runs and runs[-1]["owner"] == owner and runs[-1]["at"] + runs[-1]["windows"] == at:
                runs[-1]["windows"] += 1
            else:
                runs.append({"at": at, "windows": 1, "owner": owner})
        made.append(runs)
    kind = pa.list_(pa.struct([("at", pa.int32()), ("windows", pa.int32()), ("owner", pa.int64())]))
    return pa.table(
        [
            pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
            pa.array(made, kind),
        ],
        names=["segment_key", "runs"],
    )


def _spans(segments: DataFrame) -> DataFrame:
    """(me, text_key, first, last) runs of windows to remove, of the rows of ``segments``."""
    parts = []
    for finer in (*FINER, None):
        distinct = stored(
            segments.groupBy("anchor", "segment").agg(F.min("me").alias("owner")), "substring-distinct"
        )
        release(segments.sparkSession)
        # stored, so that the joins below have plain inputs and a hot anchor can be split
        hot = distinct.groupBy("anchor").count().where(F.col("count") > SHARD_SEGMENTS).select("anchor")
        hot = stored(hot, "substring-hot")
        last = finer is None or hot.isEmpty()
        usual = segments if last else segments.join(hot, "anchor", "left_anti")
        reference = distinct if last else distinct.join(hot, "anchor", "left_anti")
        shards = max(1, -(-reference.count() // SHARD_SEGMENTS))
        shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
        # building automata is work, not bytes: adaptive execution would merge the shards
        tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = reference.select("segment", "owner", shard).repartition(max(tasks, min(shards, 4 * tasks)), "shard")
        judged = dealt.groupBy("shard").applyInArrow(_judge, FOUND)
        places = usual.select(*KEY, "first", F.unhex(F.md5("segment")).alias("segment_key"))
        parts.append(
            places.join(judged, "segment_key")
            .select(*KEY, "first", F.explode("runs").alias("run"))
            .where("run.owner < me")
            .select(
                *KEY,
                (F.col("first") + F.col("run.at")).alias("first"),
                (F.col("first") + F.col("run.at") + F.col("run.windows")).alias("last"),
            )
        )
        if last:
            break
        segments = stored(_cut_again(segments.join(hot, "anchor", "left_semi"), finer), "substring-finer")
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.union(part)
    return spans.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def _keep(texts: DataFrame) -> DataFrame:
    """What stays of each document after its spans are taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for found, runs in zip(_words(batch), batch.column("runs").to_pylist()):
                gone = np.zeros(len(found), bool)
                for r in runs:
                    gone[r["first"] : r["last"] + WINDOW - 1] = True
                kept = [w for w, g in zip(found, gone.tolist()) if not g]
                removed.append(len(found) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEY), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                names=[*KEY, "gone", "sha_left"],
            )

    return texts.mapInArrow(run, "me long, text_key long, gone long, sha_left string")


def _copied(rows: DataFrame) -> DataFrame:
    """(sha, first_doc) of the word sequences that several documents have."""
    least = rows.where(F.col("n_words") >= WINDOW).groupBy("sha").agg(F.min("me").alias("low"), F.max("me").alias("high"))
    # stored, so that the joins with it have plain inputs and a large group of copies can be split
    return stored(least.where("low < high").select("sha", F.col("low").alias("first_doc")), "substring-copied")


def _marked(rows: DataFrame, equal: DataFrame) -> DataFrame:
    """The rows, and whether they are copies, word for word, of a smaller document."""
    copy = F.coalesce(F.col("me") > F.col("first_doc"), F.lit(False))
    return rows.join(equal, "sha", "left").withColumn("is_copy", copy)


def _affected(slim: DataFrame, originals: DataFrame) -> DataFrame:
    """Texts that have anchors in common with others, and where. Uses up ``originals``.

    The join with the texts needs more disk than all before it, so what that left goes first."""
    spark = slim.sparkSession
    runs = originals.select(*KEY, F.inline("anchors"))
    both = runs.groupBy("anchor").agg(F.min("me").alias("low"), F.max("me").alias("high"))
    # stored, so that the join below has plain inputs and a very common anchor can be split
    shared = stored(both.where("low < high").select("anchor"), "substring-shared")
    release(spark)
    runs = runs.withColumn("place", F.struct("anchor", "first", "last"))
    by_row = runs.join(shared, "anchor").groupBy(*KEY).agg(F.collect_set("place").alias("runs"))
    by_row = stored(by_row, "substring-places")  # rows repeated very often can be split below
    discard(originals, shared)
    release(spark)
    affected = stored(slim.select(*KEY, "text").join(by_row, KEY), "substring-affected")
    discard(by_row)
    return affected


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    slim = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NOBODY)).alias("me"), F.xxhash64("text").alias("text_key"), "text"
    )
    scanned = stored(_scan(slim), "substring-scanned")
    copied = _copied(scanned)
    # stored, since two branches read the anchors; without them the rows are small
    originals = _marked(scanned, copied).where(~F.col("is_copy")).select(*KEY, "anchors")
    originals = stored(originals, "substring-originals")
    rows = stored(scanned.drop("anchors"), "substring-rows")
    discard(scanned)
    release(spark)
    affected = _affected(slim, originals)
    release(spark)
    segments = stored(_segments(affected), "substring-segments")
    spans = stored(_spans(segments), "substring-spans")
    discard(segments)
    release(spark)
    # rows wholly equal in id and text have equal results: one of them is enough
    left = stored(_keep(affected.drop("runs").join(spans, KEY)).distinct(), "substring-left")
    discard(affected, spans)

    empty = F.lit(hashlib.sha256(b"").hexdigest())
    none = F.lit(0).cast("long")
    return _marked(rows, copied).join(left, KEY, "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.coalesce("gone", none)).alias("n_removed"),
        F.when(F.col("is_copy"), empty).otherwise(F.coalesce("sha_left", "sha")).alias("kept_sha256"),
    )
