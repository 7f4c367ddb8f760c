"""Scoring documents with a causal self-attention language model trained on the corpus.

A text is its words, A-Z in lower case, and one end. The model's units are a public
tokenizer's subword ids of " " + word; the first id of a word, and no other, begins with the
space, so an id sequence says which words it spells, and a word's packed ids stand for it.

The probability of a word after what came before is

    MIX * (its share of the training tokens) + (1 - MIX) * (product over its ids)

and that of an id is P(class | the ids before) * P(id | class, class of the id before). The
classes are the most frequent ids, one each, the end, and clusters of the other ids by what
stands beside them. The attention network of ``attention_net`` predicts classes over
overlapping windows; the id's share of its class is counted. All of it sums to one, so a word
never seen costs what its ids cost.

**Learning on Spark.** The texts are encoded once and stored as packed ids. From all training
documents come: the count of every word (grouped by word), hence totals and id counts; and how
often each id stands behind and before each class, hence the clusters, the shares, and the
neighbouring classes from which the network starts. Then ``ROUNDS`` rounds
of training: each task takes the round's windows of its rows through its own copy of the
parameters, and the copies are averaged, weighted by tokens (in Spark, as exact decimals, so
the order of arrival does not matter). Counts use everything, and gradient steps take every window
of every training document, each in one round. The amount of all of it grows with the corpus.

**Scoring on Spark.** Tasks score all ids in windows. Word counts reach them for the
at most ``HOT_WORDS`` most frequent words (a bounded table; words above ``LONGEST_HOT`` ids stay out).
Words outside it are joined with the stored counts by word: rows of (document, word, log
probability), of which no word has many, and which adaptive execution can split.

Collected on the driver: at most ``HOT_WORDS`` words, a count per tokenizer id and per pair of
class and id, and the parameters, whatever the input.

Defined results: a NULL text is empty; an empty text is one token, the end. A NULL id counts
as an empty text when documents are divided. Repeated rows are documents of their own. Without
training documents the counts are zero and all scores are defined. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from . import attention_net as net

HELD_OUT_OF, HELD_OUT = 5, 1  # crc32 of the id, remainder

SINGLE = 48  # ids that are a class by themselves
CLASSES = 96
COARSE_SINGLE, COARSE = 20, 32  # the classes by frequency, beside which ids are clustered
CLUSTER_ROUNDS = 15
PULL = 20  # weight of an id's plain share against its counts behind a class
WIDTH = 16
STRIDE = 16
ROUNDS = 4
RATE = 0.01
BATCH = 128  # windows per step of training
SCORED = 64  # windows scored together: their arrays stay in a core's cache
MIX = 0.4
HOT_WORDS = 1 << 18
LONGEST_HOT = 32

SLICE_BYTES = 8 << 20
KNOWN_WORDS = 400_000  # that a worker remembers from one slice to the next
# Unicode's white space beyond ASCII
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

END = 0xFFFF  # above every id of the tokenizer: 16 bits hold all
_END_WORD = END.to_bytes(2, "little")
_LOG10 = float(np.log10(np.e))
# sums of logarithms as integers of this unit do not depend on their order
_UNIT = 1e10


class Subwords(NamedTuple):
    """A byte-level vocabulary: its rank file and the pattern that cuts a text before merging."""

    path: str
    pattern: str


class _Vocabulary:
    """A worker's tokenizer of words."""

    def __init__(self, subwords: Subwords) -> None:
        import tiktoken

        with open(subwords.path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 1
        if self.size > END:
            raise ValueError("the vocabulary's ids do not fit 16 bits")
        self.encode = tiktoken.Encoding(
            "subwords", pat_str=subwords.pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.known = pa.array([], pa.binary())  # words met before, and their ids
        self.known_ids, self.known_lengths = np.array([], "<u2"), np.array([], np.int32)
        self.begins = np.zeros(END + 1, bool)  # ids of a text that begins with the space; the end
        self.begins[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.begins[END] = True

    def _spell(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. Words are encoded together: the space before
        a word keeps it apart from the one before, unless they hold Unicode's white space."""
        if not len(words):
            return np.array([], "<u2"), np.array([], np.int32)
        all_words = pa.LargeListArray.from_arrays(pa.array([0, len(words)]), words.cast(pa.large_binary()))
        text = " " + pc.binary_join(all_words, pa.scalar(b" ", pa.large_binary()))[0].as_py().decode()
        ids = np.array([] if _OTHER_SPACE.search(text) else self.encode(text), "<u2")
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) == len(words):
            return ids, np.diff(starts, append=len(ids)).astype(np.int32)
        each = [np.array(self.encode(" " + w.decode()), "<u2") for w in words.to_pylist()]
        return np.concatenate(each), np.array([len(x) for x in each], np.int32)

    def spell(self, words: list[bytes]) -> list[bytes]:
        """Each word's packed ids."""
        ids, lengths = self._spell(pa.array(words, pa.binary()))
        packed, ends = ids.tobytes(), [0, *(2 * np.cumsum(lengths)).tolist()]
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct words: ids, where each word's begin among them, and how many it has."""
        place = pc.index_in(words, self.known)
        missing = words.filter(place.is_null())
        ids, lengths = self._spell(missing)
        # the new words stand behind those known
        place = pc.fill_null(place, -1).to_numpy().copy()
        place[place < 0] = len(self.known) + np.arange(len(missing))
        self.known = pa.concat_arrays([self.known, missing])
        self.known_ids = np.concatenate([self.known_ids, ids])
        self.known_lengths = np.concatenate([self.known_lengths, lengths])
        starts = np.cumsum(self.known_lengths, dtype=np.int32) - self.known_lengths
        made = self.known_ids, starts[place], self.known_lengths[place]
        if len(self.known) > KNOWN_WORDS:
            self.known, self.known_ids, self.known_lengths = self.known[:0], ids[:0], lengths[:0]
        return made

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Each text's number of words, and its packed ids: every distinct word is spelled once,
        and the texts are put together from the spellings."""
        # only A-Z is lowered, only ASCII white space splits
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words, text = lists.flatten(), lists.value_parent_indices()
        real = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves empty ones
        words, text = words.filter(real).dictionary_encode(), text.filter(real)
        counts = np.bincount(text.to_numpy(), minlength=len(texts))
        ids, starts, lengths = self._look_up(words.dictionary.cast(pa.binary()))
        order = words.indices.to_numpy()
        each = lengths[order]
        ends = np.append(0, np.cumsum(each))
        places = np.repeat(starts[order] - ends[:-1].astype(np.int32), each)
        places += np.arange(len(places), dtype=np.int32)
        made = ids[places] if len(places) else ids
        bounds = (2 * ends[np.append(0, np.cumsum(counts))]).astype(np.int32)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(made))]
        return counts, pa.Array.from_buffers(pa.binary(), len(texts), buffers)


_VOCABULARIES: dict[Subwords, _Vocabulary] = {}


def vocabulary(subwords: Subwords) -> _Vocabulary:
    if subwords not in _VOCABULARIES:
        _VOCABULARIES[subwords] = _Vocabulary(subwords)
    return _VOCABULARIES[subwords]


def held_out() -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(key) % HELD_OUT_OF == HELD_OUT


def encode(docs: DataFrame, subwords: Subwords) -> DataFrame:
    """Documents as packed ids: doc_id, held_out, n_words, ids; stored, and numbered by ``uid``."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(subwords)
        for batch in _slices(batches, "text"):
            counts, packed = known.encode_texts(batch.column("text"))
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(counts, pa.int64()), packed]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_words", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_words long, ids binary")
    return stored(made.withColumn("uid", F.monotonically_increasing_id()), "lm-ids")


def _slices(batches: Iterator[pa.RecordBatch], by: str = "ids") -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE_BYTES`` of a column; a longer value is a run by itself."""
    for batch in batches:
        start = size = 0
        for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column(by)), 0).to_pylist()):
            if row > start and size + length > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if batch.num_rows > start:
            yield batch.slice(start)


class _Texts:
    """The texts of a batch in one array: the end before each one, and the end behind the last."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        parts = batch.column("ids").to_pylist()
        self.ids = np.frombuffer(_END_WORD + _END_WORD.join([*parts, b""]), "<u2")
        self.lengths = np.array([len(part) // 2 + 1 for part in parts], np.int64)  # with the end
        self.starts = np.cumsum(self.lengths) - self.lengths

    @property
    def known(self) -> np.ndarray:
        """What each predicted position follows."""
        return self.ids[:-1]

    @property
    def predicted(self) -> np.ndarray:
        return self.ids[1:]


def _spelled(ids: np.ndarray, starts: np.ndarray) -> pa.BinaryArray:
    """The words that begin at ``starts``, as packed ids."""
    ids = np.ascontiguousarray(ids)
    ends = np.append(starts, len(ids)).astype(np.int32) * np.int32(2)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(ids)]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _added(rows: DataFrame, key: str, kind: str, count) -> DataFrame:
    """``count`` of each batch gives arrays of keys and numbers; their sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers = count(batch)
            yield pa.RecordBatch.from_arrays([keys, pa.array(numbers, pa.int64())], names=[key, "n"])

    return rows.mapInArrow(run, f"{key} {kind}, n long").groupBy(key).agg(F.sum("n").alias("n"))


def word_counts(training: DataFrame, subwords: Subwords) -> DataFrame:
    """Occurrences of every word (as packed ids), stored."""

    def count(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
        ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2")
        found = _spelled(ids, np.flatnonzero(vocabulary(subwords).begins[ids])).dictionary_encode()
        return found.dictionary, np.bincount(found.indices, minlength=len(found.dictionary))

    return stored(_added(training.select("ids"), "word", "binary", count), "lm-words")


def id_counts(words: DataFrame) -> np.ndarray:
    """Occurrences of every id, from those of the words."""

    def count(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
        spelled = batch.column("word").to_pylist()
        times = np.repeat(batch.column("n").to_numpy(), [len(w) // 2 for w in spelled])
        totals = np.bincount(np.frombuffer(b"".join(spelled), "<u2"), times)
        seen = np.flatnonzero(totals)
        return pa.array(seen, pa.int32()), totals[seen].astype(np.int64)

    made = np.zeros(END + 1)
    for row in _added(words, "id", "int", count).collect():
        made[row.id] = row.n
    return made


def frequent(words: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """At most ``HOT_WORDS`` words and their counts: those above a count, of which there are
    not more. Counts are looked at in classes, eight for each doubling."""
    short = words.where(F.length("word") <= 2 * LONGEST_HOT).withColumn("level", F.floor(8 * F.log2("n")))
    left, least = HOT_WORDS, None
    for row in sorted(short.groupBy("level").count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row.level
    found = short.where(F.col("level") >= (1 << 30 if least is None else least)).select("word", "n").toArrow()
    found = found.sort_by("word").combine_chunks()
    return pa.concat_arrays(found["word"].cast(pa.binary()).chunks), found["n"].to_numpy()


def by_frequency(counts: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """A first class of every id: the most frequent ones, the end, and bins of equal mass of
    those that begin a word and of those that go on. ``size``: the tokenizer's ids."""
    order = np.lexsort((np.arange(size), -counts[:size]))
    made = np.zeros(END + 1, np.int64)
    made[order[:COARSE_SINGLE]] = np.arange(COARSE_SINGLE)
    made[END] = COARSE_SINGLE
    bins = COARSE - COARSE_SINGLE - 1
    at = COARSE_SINGLE + 1
    for group, share in ((True, bins // 2), (False, bins - bins // 2)):
        ids = order[COARSE_SINGLE:][begin[order[COARSE_SINGLE:]] == group]
        mass = np.cumsum(counts[ids] + 0.5)
        if len(ids):
            made[ids] = at + (np.append(0, mass[:-1]) / mass[-1] * share).astype(np.int64)
        at += share
    return made


def clustered(counts: np.ndarray, beside: np.ndarray, size: int) -> np.ndarray:
    """The class of every id: the most frequent ones, the end, and clusters (k-means of the
    square roots of the shares, weighted by count) of the others by their neighbours.

    ``beside``: how often each id (rows) stands behind and before each coarse class.
    """
    order = np.lexsort((np.arange(size), -counts[:size]))
    ids = order[SINGLE:]
    usual = (beside.sum(0) + 1) / (beside.sum() + beside.shape[1])
    x = beside[ids] + 2 * PULL * usual
    x = np.sqrt(x / x.sum(1, keepdims=True)).astype(np.float32)
    weight = counts[ids] + 0.5
    centres = x[: CLASSES - SINGLE - 1].copy()
    for _ in range(CLUSTER_ROUNDS):
        nearest = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        mass = np.bincount(nearest, weight, len(centres))
        sums = np.stack([np.bincount(nearest, weight * column, len(centres)) for column in x.T], 1)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centres).astype(np.float32)
    made = np.zeros(END + 1, np.int64)
    made[order[:SINGLE]] = np.arange(SINGLE)
    made[END] = SINGLE
    made[ids] = SINGLE + 1 + nearest
    return made


def neighbours(training: DataFrame, class_of: np.ndarray, classes: int, size: int, before: bool) -> np.ndarray:
    """How often each id stands behind each class, or also before it: (1 or 2, classes,
    ``size`` + 1), the end last."""
    small, sides, width = class_of.astype(np.uint8), 1 + before, size + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((sides, classes * width), np.int32)
        for batch in _slices(batches):
            texts = _Texts(batch)
            for side, (by, ids) in enumerate(((texts.known, texts.predicted), (texts.predicted, texts.known))[:sides]):
                key = small[by].astype(np.int32) * np.int32(width) + np.minimum(ids, size)
                np.add.at(totals[side], key, np.int32(1))
            if totals.max() > 1 << 30:  # before a sum leaves 32 bits
                yield out(totals)
                totals[:] = 0
        yield out(totals)

    def out(totals: np.ndarray) -> pa.RecordBatch:
        seen = np.flatnonzero(totals)
        return pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(totals.ravel()[seen], pa.int64())], names=["key", "n"]
        )

    rows = training.select("ids").mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))
    made = np.zeros(sides * classes * width)
    for batch in rows.toArrow().to_batches():
        made[batch["key"].to_numpy()] = batch["n"].to_numpy()
    return made.reshape(sides, classes, width)


def shares(counts: np.ndarray, behind: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """log10 of each id's share of its class, by the class before it: (classes, ids), the end
    last. Few observations behind a class are pulled to the share in all places."""
    size = behind.shape[1] - 1
    smooth = np.append(counts[:size] + 0.5, 1)
    of = classes_with_end(class_of, size)
    plain = smooth / np.bincount(of, smooth, CLASSES)[of]
    made = np.empty(behind.shape, np.float32)
    for row, seen in zip(made, behind):
        row[:] = np.log10((seen + PULL * plain) / (np.bincount(of, seen, CLASSES)[of] + PULL))
    return made


def classes_with_end(class_of: np.ndarray, size: int) -> np.ndarray:
    return np.append(class_of[:size], class_of[END])


def _trained(training: DataFrame, class_of: np.ndarray, values: np.ndarray, turn: int) -> tuple[np.ndarray, int]:
    """One round: every task's own training from the same values, then their average, and the
    number of ids and ends it learned from. Every window belongs to one of the rounds."""
    small = class_of.astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = net.Trainer(net.unflat(values, CLASSES, WIDTH, STRIDE), STRIDE, RATE / 2**turn)
        for batch in _slices(batches):
            texts = _Texts(batch)
            found = net.Windows(texts.starts, texts.lengths, STRIDE)
            pieces = found.pieces(small[texts.ids])
            mine = np.flatnonzero((found.number + batch.column("uid").to_numpy()[found.text]) % ROUNDS == turn)
            for at in range(0, len(mine), BATCH):
                trainer.step(*found.cut(pieces, mine[at : at + BATCH]))
        if trainer.seen:
            scaled = np.rint(net.flat(trainer.net.p).astype(np.float64) * (1 << 20)).astype(np.int64)
            arrays = [pa.array(range(len(scaled)), pa.int32()), pa.array(scaled), pa.array([trainer.seen] * len(scaled), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["at", "value", "weight"])

    weight = F.col("weight").cast("decimal(19,0)")
    rows = (
        training.select("uid", "ids")
        .mapInArrow(run, "at int, value long, weight long")
        .groupBy("at")
        .agg(F.sum(F.col("value").cast("decimal(19,0)") * weight).alias("value"), F.sum(weight).alias("weight"))
        .collect()
    )
    made = values.copy()
    for row in rows:
        made[row.at] = float(row.value) / float(row.weight) / (1 << 20)
    return made, int(rows[0].weight) if rows else 0


@dataclass
class Model:
    """What was learned. ``words``: the stored counts; the rest is of bounded size."""

    subwords: Subwords
    words: DataFrame | None
    train_tokens: int  # with one end per document
    distinct: int
    hot: pa.BinaryArray  # the end and the most frequent words
    hot_counts: np.ndarray
    class_of: np.ndarray
    share: np.ndarray  # log10 of an id's share of its class behind each class
    values: np.ndarray  # the network's parameters
    learned: int  # ids and ends in the windows of all gradient steps


def fit(training: DataFrame, subwords: Subwords) -> Model:
    """The model of encoded documents."""
    words = word_counts(training, subwords)
    texts = training.count()
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).first()
    hot, hot_counts = frequent(words)
    counts = id_counts(words)
    known = vocabulary(subwords)
    coarse = by_frequency(counts, known.begins, known.size)
    beside = neighbours(training, coarse, COARSE, known.size, before=True)
    class_of = clustered(counts, beside.reshape(2 * COARSE, -1).T, known.size)
    behind = neighbours(training, class_of, CLASSES, known.size, before=False)[0]
    of = classes_with_end(class_of, known.size)
    pairs = np.stack([np.bincount(of, row, CLASSES) for row in behind])
    share = shares(counts, behind, class_of)
    values = net.flat(net.start(pairs, WIDTH, STRIDE))
    learned = 0
    for turn in range(ROUNDS):
        values, seen = _trained(training, class_of, values, turn)
        learned += seen
    # no id has these classes: they get no probability
    unused = np.bincount(of, minlength=CLASSES) == 0
    net.unflat(values, CLASSES, WIDTH, STRIDE, copy=False)["bias"][unused] = -1e4
    return Model(
        subwords,
        words,
        (totals.n or 0) + texts,
        totals.kinds + (texts > 0),
        pa.concat_arrays([pa.array([_END_WORD], pa.binary()), hot]),
        np.append(texts, hot_counts).astype(np.int64),
        class_of,
        share,
        values,
        learned,
    )


def id_scores(batch: pa.RecordBatch, model: Model, network: net.Net, small: np.ndarray) -> tuple[_Texts, np.ndarray]:
    """log10 probability of every id and end of a batch's texts, each from one window."""
    texts = _Texts(batch)
    found = net.Windows(texts.starts, texts.lengths, STRIDE)
    pieces = found.pieces(small[texts.ids])
    parts = []
    for at in range(0, len(found), SCORED):
        *tokens, real = found.cut(pieces, slice(at, at + SCORED))
        parts.append(network.log_probabilities(*tokens)[real])  # windows and positions follow the texts
    made = np.concatenate(parts).astype(np.float64)
    made *= _LOG10
    width = model.share.shape[1]
    place = small[texts.known].astype(np.int32) * width + np.minimum(texts.predicted, width - 1)
    made += model.share.ravel()[place]
    return texts, made


_SCORED = "n_known long, base double, score double, rare array<struct<word: binary, logp: float>>"


def score(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    hot, hot_counts, total = model.hot, model.hot_counts, model.train_tokens
    smooth = total + 0.5 * (model.distinct + 1)
    slim = replace(model, words=None)  # a task has no use for a table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = net.Net(net.unflat(slim.values, CLASSES, WIDTH, STRIDE), STRIDE)
        small, begin = slim.class_of.astype(np.uint8), vocabulary(slim.subwords).begins
        for batch in _slices(batches):
            texts, logs = id_scores(batch, slim, network, small)
            starts = np.flatnonzero(begin[texts.predicted])  # of words and ends
            logs = np.add.reduceat(logs, starts)
            found = _spelled(texts.predicted, starts)
            place = pc.fill_null(pc.index_in(found, hot), -1).to_numpy(zero_copy_only=False)
            frequent = place >= 0
            n = np.where(frequent, hot_counts[place], 0)
            tokens = batch.column("n_words").to_numpy() + 1
            begun = np.cumsum(tokens) - tokens
            with np.errstate(divide="ignore", under="ignore"):
                mixed = np.where(
                    n > 0, np.log10(MIX * n / max(total, 1) + (1 - MIX) * 10.0**logs), np.log10(1 - MIX) + logs
                )
            base = np.where(frequent, np.log10((n + 0.5) / smooth), 0)
            few = np.flatnonzero(~frequent)
            ends = np.append(np.add.reduceat(~frequent, begun, dtype=np.int64).cumsum(), 0)
            rare = pa.ListArray.from_arrays(
                pa.array(np.roll(ends, 1), pa.int32()),
                pa.StructArray.from_arrays(
                    [found.take(pa.array(few)), pa.array(logs[few], pa.float32())],
                    names=["word", "logp"],
                ),
            )
            arrays = [
                batch.column("uid"), batch.column("doc_id"), batch.column("held_out"), pa.array(tokens, pa.int64()),
                pa.array(np.add.reduceat(frequent & (n > 0), begun, dtype=np.int64)),
                pa.array(np.add.reduceat(base, begun)),
                pa.array(np.add.reduceat(np.where(frequent, mixed, 0), begun)), rare,
            ]
            names = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    scored = stored(
        encoded.mapInArrow(run, f"uid long, doc_id {kind}, held_out boolean, n_tokens long, {_SCORED}"), "lm-scores"
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    logp = F.col("logp").cast("double")
    rest = (
        scored.select("uid", F.inline("rare"))
        .join(model.words, "word", "left")
        .select(
            "uid",
            (n > 0).cast("long").alias("known"),
            F.rint(F.log10((n + 0.5) / F.lit(smooth)) * _UNIT).cast("long").alias("base"),
            F.rint(
                F.when(n > 0, F.log10(MIX * n / F.lit(max(total, 1)) + (1 - MIX) * F.pow(F.lit(10.0), logp))).otherwise(
                    F.lit(float(np.log10(1 - MIX))) + logp
                )
                * _UNIT
            ).cast("long").alias("score"),
        )
        .groupBy("uid")
        .agg(*(F.sum(F.col(c).cast("decimal(19,0)")).alias(f"more_{c}") for c in ("known", "base", "score")))
    )

    def more(name: str) -> Column:
        return F.coalesce(F.col(f"more_{name}").cast("double"), F.lit(0.0))

    return scored.drop("rare").join(rest, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more("known").cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more("base") / _UNIT).alias("base_score"),
        (F.col("score") + more("score") / _UNIT).alias("score"),
    )


def scores(docs: DataFrame, subwords: Subwords) -> DataFrame:
    """Train on the documents that are not held out and score all."""
    encoded = encode(docs, subwords)
    return score(encoded, fit(encoded.where(~F.col("held_out")), subwords))
