"""Quality rules: fixed counts, and character n-gram perplexity within language bands.

**Model.** Spark counts every ``ORDER``-character sequence of every whole text by language
(documents are padded in front), and from the distinct sequences the continuation counts of
the shorter ones: how many characters precede them. That gives an interpolated modified
Kneser-Ney model with discounts for counts of one, two, and three or more, from the counts
of counts of each order and language. Characters beyond 16 bits are folded to 16 bits, so a
sequence is one exact 64-bit number while it is counted.

Documents are dealt to two halves by a hash of their text, and each is scored by the model
of the other half: a text's own sequences, and those of its exact copies, do not make it
look familiar. A language that the other half lacks is scored by its own.

**Storage.** For scoring, every table is reduced to 2 ** ``SLOT_BITS`` slots of a 64-bit
hash of half, language and sequence, and kept as arrays sorted by slot. So what is sent to the
executors is bounded by ``SLOT_BITS`` whatever the corpus, while the counts behind it cover
all of it. Sequences in one slot share their counts; none is dropped.

**Bands.** A document's score is the mean negative log probability of its characters (the
logarithm of its perplexity). Per language, the quartiles of the documents that pass the
fixed rules give a centre and a spread, and documents beyond ``WIDTH`` spreads on either
side are rejected: text above the band is unlike its language, text below it repeats
itself. A band is never narrower than ``LEAST_WIDTH`` on each side, so a language in which
most documents are copies of one text does not lose the others.

**Edge rows.** NULL text: no words, which fails the fixed rules. A NULL and an empty language
are one. Every row is judged for itself, so repeated rows get equal verdicts. Whole texts
are read, whatever their length. ``keep`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from shopflow.session import stored

from .texts import with_columns

ORDER = 4
SLOT_BITS = 22
WIDTH = 8.0  # spreads: half the distance of the quartiles
LEAST_WIDTH = 0.6  # nats per character
LEAST_WORDS = 50
MERGE_AT = 4_000_000  # sequences a counting task holds before it folds them
NO_LANGUAGE = ""
HALVES = 2

# Characters that count as symbols
SYMBOLS = "#*$%&|<>"


# ---- fixed rules


def base_rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    found = text.split()
    joined = b"".join(found)
    # code points: all bytes but the continuation bytes
    chars = len(joined) if joined.isascii() else int(((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80).sum())
    symbols = sum(text.count(s.encode()) for s in SYMBOLS)
    duplicates = 0
    if b"\n" in text:
        seen = set()
        for line in text.split(b"\n"):
            if line in seen:
                duplicates += 1
            elif line.split(None, 1):
                seen.add(line)
    repeats = 0
    n = len(found)
    if n > 3:
        ids: dict[bytes, int] = {}
        words = np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.int64, n)
        if len(ids) < 1 << 20:
            windows = (words[:-2] * len(ids) + words[1:-1]) * len(ids) + words[2:]
            _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        else:
            pairs = np.unique(words[:-1] * len(ids) + words[1:], return_inverse=True)[1]
            windows = pairs[:-1] * len(ids) + words[2:]
            _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        often = times[back] > 1
        if often.any():
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k : n - 2 + k] |= often
            repeats = int(covered.sum())
    return n, chars, symbols, duplicates, repeats


# ---- counting


def half(text: str) -> int:
    """The half of the corpus a text belongs to."""
    return zlib.crc32(text.encode(errors="surrogatepass")) % HALVES


def model_name(lang: str | None, which: int) -> str:
    return f"{which}:{lang or NO_LANGUAGE}"


def _codes(text: str) -> np.ndarray:
    """The characters as 16-bit numbers in 64-bit words, with padding in front."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = (points ^ (points >> np.uint32(16))) & np.uint32(0xFFFF)
    return np.concatenate([np.zeros(ORDER - 1, np.uint64), folded.astype(np.uint64)])


def grams(text: str) -> np.ndarray:
    """The sequence of ``ORDER`` characters that ends at each character."""
    codes = _codes(text)
    n = len(codes) - (ORDER - 1)
    made = np.zeros(n, np.uint64)
    for k in range(ORDER):
        made = (made << np.uint64(16)) | codes[k : n + k]
    return made


def _folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each sequence stands in all texts of a language, by half;
    ``lang`` is a ``model_name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh: dict[str, list[np.ndarray]] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0

        def fold() -> None:
            for lang, parts in fresh.items():
                new = np.unique(np.concatenate(parts), return_counts=True)
                held[lang] = _folded([held[lang], new]) if lang in held else new
            fresh.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array(keys.view(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text")):
                value = text.as_py()
                if value:
                    made = grams(value)
                    fresh.setdefault(model_name(lang, half(value)), []).append(made)
                    waiting += len(made)
                    if waiting > MERGE_AT:
                        fold()
                        waiting = 0
                        if sum(len(k) for k, _ in held.values()) > MERGE_AT:
                            yield from flush()
        fold()
        yield from flush()

    slim = docs.select(F.col("lang").cast("string"), "text")
    counted = slim.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ---- model


def _mix(x: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit integers with seed 42, as Spark's xxhash64 of a long."""
    p1, p2, p3, p4, p5 = (
        np.uint64(p)
        for p in (
            0x9E3779B185EBCA87,
            0xC2B2AE3D27D4EB4F,
            0x165667B19E3779F9,
            0x85EBCA77C2B2AE63,
            0x27D4EB2F165667C5,
        )
    )

    def turned(v: np.ndarray, by: int) -> np.ndarray:
        return (v << np.uint64(by)) | (v >> np.uint64(64 - by))

    with np.errstate(over="ignore"):
        h = np.full(len(x), np.uint64(42) + p5 + np.uint64(8))
        h ^= turned(x * p2, 31) * p1
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def _salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 42))


def slots(keys: np.ndarray, lang: str) -> np.ndarray:
    return (_mix(keys ^ _salt(lang)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def _slot(key: str) -> Column:
    mixed = F.xxhash64(F.col(key).bitwiseXOR(F.xxhash64("lang")))
    return F.shiftrightunsigned(mixed, 64 - SLOT_BITS).cast("int").alias("slot")


@dataclass
class Model:
    """Sorted hash arrays. Order k (from 1): counts[k] of its sequences by slot; after[k] of
    contexts one character shorter: total, and how many followers have count 1, 2, 3 or
    more. ``discounts``: by language and order."""

    counts: dict[int, tuple[np.ndarray, np.ndarray]]
    after: dict[int, tuple[np.ndarray, np.ndarray]]
    discounts: dict[str, np.ndarray]
    alphabet: dict[str, int]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], slot: np.ndarray) -> np.ndarray:
        keys, values = table
        out = np.zeros((len(slot), *values.shape[1:]), np.float64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, slot), len(keys) - 1)
            hit = keys[at] == slot
            out[hit] = values[at[hit]]
        return out

    def log_probability(self, sequences: np.ndarray, lang: str) -> np.ndarray:
        """log p(last character | the characters before it) of ``ORDER``-character sequences."""
        probability = np.full(len(sequences), 1.0 / (self.alphabet.get(lang, 0) + 1))
        known = self.discounts.get(lang)
        if known is None:
            return np.log(probability)
        for order in range(1, ORDER + 1):
            mask = np.uint64((1 << (16 * order)) - 1)
            part = sequences & mask
            count = self._find(self.counts[order], slots(part, lang))
            followers = self._find(self.after[order], slots(part >> np.uint64(16), lang))
            total = followers[:, 0]
            d = known[order - 1]
            cut = d[np.minimum(count, 3).astype(int)]
            with np.errstate(divide="ignore", invalid="ignore"):
                mixed = (np.maximum(count - cut, 0) + followers[:, 1:] @ d[1:] * probability) / total
            probability = np.where(total > 0, mixed, probability)
        return np.log(np.maximum(probability, 1e-300))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts for counts 0, 1, 2, 3+ from the counts of counts; small corpora lack some."""
    if not n1 or not n2:
        return [0.0, 0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return [0.0, *(min(max(x, 0.05), k) for x, k in zip(d, (1, 2, 3)))]


def fit(counted: DataFrame) -> Model:
    """The model of counted sequences (lang, gram, n)."""
    counts, after, rates, sizes = {}, {}, {}, {}
    level = counted
    for order in range(ORDER, 0, -1):
        if order < ORDER:  # continuation counts: distinct longer sequences that end in this one
            suffix = F.col("gram").bitwiseAND((1 << (16 * order)) - 1)
            level = level.groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = stored(level, f"grams-{order}")
        table = level.groupBy(_slot("gram")).agg(F.sum("n").alias("n")).toArrow()
        counts[order] = _sorted(table, ["n"], flat=True)
        context = level.withColumn("context", F.shiftrightunsigned("gram", 16))
        sums = [F.sum("n").alias("total")] + [
            F.count_if(F.col("n") == k if k < 3 else F.col("n") >= 3).alias(f"n{k}") for k in (1, 2, 3)
        ]
        by_slot = context.groupBy(_slot("context")).agg(*sums).toArrow()
        after[order] = _sorted(by_slot, ["total", "n1", "n2", "n3"])
        for r in level.groupBy("lang").agg(*(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)), F.count(F.lit(1)).alias("all")).collect():
            rates.setdefault(r["lang"], {})[order] = _discounts(r.n1, r.n2, r.n3, r.n4)
            sizes[r["lang"]] = r["all"]  # at last, of order 1: the characters seen
    discounts = {lang: np.array([by[o] for o in range(1, ORDER + 1)]) for lang, by in rates.items()}
    return Model(counts, after, discounts, sizes)


def _sorted(table: pa.Table, columns: list[str], flat: bool = False) -> tuple[np.ndarray, np.ndarray]:
    keys = table.column("slot").to_numpy()
    order = np.argsort(keys)
    values = np.stack([table.column(c).to_numpy() for c in columns], axis=1).astype(np.float32)[order]
    return keys[order], values[:, 0] if flat else values


# ---- scoring


MADE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double"
)


def score_texts(model: Model, langs: list[str | None], texts: list[str]) -> list[float | None]:
    """Mean negative log probability per character, by the other half; None for no text."""
    out: list[float | None] = [None] * len(texts)
    by_lang: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if text:
            own = half(text)
            other = model_name(langs[i], 1 - own)
            name = other if other in model.discounts else model_name(langs[i], own)
            by_lang.setdefault(name, []).append(i)
    for lang, rows in by_lang.items():
        parts = [grams(texts[i]) for i in rows]
        ends = np.cumsum([0, *map(len, parts)])[:-1]
        distinct, back = np.unique(np.concatenate(parts), return_inverse=True)
        sums = np.add.reduceat(model.log_probability(distinct, lang)[back], ends)
        for i, total, part in zip(rows, sums.tolist(), parts):
            out[i] = -total / len(part)
    return out


def _slices(texts: list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters."""
    low = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def scored(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` with the counts and the score of each document, stored, and the
    made columns' names, which clash with none of ``keep``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(count_grams(docs)))
    prefix = "q_"
    while any(c.startswith(prefix) for c in keep):
        prefix = "_" + prefix
    schema, names = docs.select(*keep).schema, []
    for field in StructType.fromDDL(MADE + ", band string"):
        names.append(prefix + field.name)
        schema = schema.add(names[-1], field.dataType)
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs = batch.column("lang").to_pylist()
            rows = [base_rules(t.encode(errors="surrogatepass")) for t in texts]
            scores: list[float | None] = []
            for low, high in _slices(texts):
                scores += score_texts(model.value, langs[low:high], texts[low:high])
            failed = [n < LEAST_WORDS or 100 * repeats > 50 * n for n, *_, repeats in rows]
            columns = [*(zip(*rows) if rows else [[]] * 5), failed, scores, [x or NO_LANGUAGE for x in langs]]
            made = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
            yield with_columns(batch, keep, made)

    read = docs.select(*dict.fromkeys([*keep, "text", "lang"]))
    return stored(read.mapInArrow(run, schema), "quality-scores"), names


def judged(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``scored`` with the verdict; names of the made columns by what they hold."""
    table, names = scored(docs, keep)
    made = dict(zip([f.name for f in StructType.fromDDL(MADE)] + ["band"], names))
    score, band = F.col(made["score"]), made["band"]
    quartiles = F.percentile_approx(score, [0.25, 0.5, 0.75], 10_000).alias("quartiles")
    bands = table.where(~F.col(made["base_failed"])).groupBy(F.col(band).alias("band_lang")).agg(quartiles)
    q = [F.col("quartiles")[i] for i in range(3)]
    bands = bands.select(
        "band_lang",
        (q[1] - F.greatest(WIDTH * (q[1] - q[0]), F.lit(LEAST_WIDTH))).alias("band_low"),
        (q[1] + F.greatest(WIDTH * (q[2] - q[1]), F.lit(LEAST_WIDTH))).alias("band_high"),
    )
    bands = stored(bands, "quality-bands")  # one row per language: its size decides the join
    joined = table.select(F.struct("*").alias("row"), F.col(band).alias("band_lang")).join(bands, "band_lang", "left")
    score = F.col("row")[made["score"]]
    fine = ~F.col("row")[made["base_failed"]] & score.between(F.col("band_low"), F.col("band_high"))
    return joined.select("row", F.coalesce(fine, F.lit(False)).alias("kept")), made


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and log_perplexity, of every row of ``docs``."""
    rows, made = judged(docs.select("doc_id", "text", "lang"), ["doc_id"])
    names = [n for n in made if n not in ("score", "band")]
    columns = [F.col("row")[made[n]].alias(n) for n in names]
    return rows.select(
        F.col("row")["doc_id"].alias("doc_id"), *columns, "kept", F.col("row")[made["score"]].alias("log_perplexity")
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged."""
    rows, _ = judged(docs, docs.columns)
    return rows.where("kept").select(*(F.col("row")[c].alias(c) for c in docs.columns))
