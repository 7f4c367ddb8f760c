"""Secret scan: fixed patterns, and strings that surrounding code cannot explain.

The fixed patterns give the spans of kinds assign, access and hex. The kind novel adds
strings without a pattern of their own: a candidate is a run of ``CANDIDATE`` characters
with letters and digits, within ``REACH`` characters after a word such as key or password,
outside all other spans. Its marginal compressed size is what zstandard, primed with an
identifier dictionary, needs for the surrounding text with the candidate, less what it
needs without it. Names, paths and repeated values are already in the dictionary or in the
context and cost little; random strings cost nearly their entropy. At ``NOVEL_BYTES`` per
character or more the candidate is reported.

The dictionary holds the identifiers seen most often before ``=``, ``:``, ``(`` or ``[`` in
all documents, counted by Spark; it is at most ``DICTIONARY_BYTES`` long, so its broadcast
is bounded whatever the corpus. It needs one pass over the texts, the scan a second one.

**Edge rows.** NULL text: empty, no spans. Positions are code points, end exclusive. Every
row is scanned for itself, so repeated rows and NULL doc_ids need no rule. Whole texts are
read, whatever their length. ``redact`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .texts import per_document, with_columns

KINDS = ("assign", "access", "hex", "novel")
# The base patterns, the length that matters, and the least length
_BASE = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
)
_HINTS = ("passw", "secret", "token", "api")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")

SENSITIVE = re.compile(r"passw|passphrase|secret|token|api.?key|access.?key|private.?key|auth|credential|bearer", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
REACH = 48
CONTEXT = 256
NOVEL_BYTES = 0.55
LEVEL = 3

_BEFORE_SIGN = re.compile(r"[=:(\[]")
_IDENTIFIER_END = re.compile(r"([A-Za-z_][A-Za-z0-9_]{2,39})[\x20\"']{0,2}\Z")
DICTIONARY_ENTRIES = 4096
DICTIONARY_BYTES = 64 << 10
FLUSH = 100_000  # identifiers a task counts before it passes them on

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    found: list[Span] = []
    lower = text.lower()
    possible = (any(h in lower for h in _HINTS), "AKIA" in text, _LONG_HEX.search(text))
    for kind, (pattern, group, least) in enumerate(_BASE):
        if possible[kind]:
            for m in pattern.finditer(text):
                if m.end(group) - m.start(group) >= least:
                    found.append((m.start(), kind, m.end()))
    return sorted(found)


class Novelty:
    """Marginal compressed size of a string in its context."""

    def __init__(self, dictionary: bytes) -> None:
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=primed if dictionary else None, write_checksum=False, write_content_size=False
        )

    def _size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode(errors="surrogatepass")))

    def marginal(self, text: str, start: int, end: int) -> int:
        """Bytes the compressor needs for text[start:end] beside its surroundings."""
        before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        return self._size(before + text[start:end] + after) - self._size(before + after)

    def spans(self, text: str, others: list[Span]) -> list[Span]:
        found: list[Span] = []
        done = 0
        for word in SENSITIVE.finditer(text):
            for m in CANDIDATE.finditer(text, max(done, word.end()), word.end() + REACH + 1):
                whole = CANDIDATE.match(text, m.start())  # the run may go on beyond the reach
                start, end = whole.span()
                done = max(done, end)
                value = whole.group()
                if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                    continue
                if any(start < o[2] and o[0] < end for o in others):
                    continue
                if self.marginal(text, start, end) >= NOVEL_BYTES * (end - start):
                    found.append((start, KINDS.index("novel"), end))
        return found


def identifiers(text: str) -> Iterator[str]:
    """Names that stand before an assignment, a call, an index or a colon."""
    for sign in _BEFORE_SIGN.finditer(text):
        m = _IDENTIFIER_END.search(text, max(0, sign.start() - 42), sign.start())
        if m:
            yield m.group(1)


def dictionary(docs: DataFrame) -> bytes:
    """The identifier dictionary of a corpus: the commonest names last, where zstandard
    reaches them with the shortest offsets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["name", "n"])

        for batch in batches:
            for text in batch.column("text"):
                value = text.as_py()
                if value:
                    seen.update(identifiers(value))
                if len(seen) > FLUSH:
                    yield flush()
                    seen.clear()
        yield flush()

    counted = docs.select("text").mapInArrow(count, "name string, n long")
    top = (
        counted.groupBy("name")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "name")
        .limit(DICTIONARY_ENTRIES)
        .collect()
    )
    return "\n".join(r.name for r in reversed(top)).encode()[-DICTIONARY_BYTES:]


def all_spans(text: str, novelty: Novelty) -> tuple[list[Span], list[Span]]:
    """The base spans, and these with the novel ones."""
    base = base_spans(text)
    return base, sorted(base + novelty.spans(text, base))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_NOVELTY: dict[bytes, Novelty] = {}


def _novelty(primed: bytes) -> Novelty:
    if primed not in _NOVELTY:
        _NOVELTY.clear()
        _NOVELTY[primed] = Novelty(primed)
    return _NOVELTY[primed]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs))

    def work(text: str) -> tuple:
        base, spans = all_spans(text, _novelty(shared.value))
        counts = Counter(kind for _, kind, _ in spans)
        digest = hashlib.sha256(written(base).encode()).hexdigest()
        return counts[0], counts[1], counts[2], digest, written(spans), counts[3]

    made = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"
    return per_document(docs.select("doc_id", "text"), ["doc_id"], work, made)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with secrets masked in ``text``; where there is a
    long column n_chars, it follows the new text in documents that changed."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in names else None
            for i, text in enumerate(texts):
                spans = all_spans(text, _novelty(shared.value))[1] if text else []
                if spans:
                    texts[i] = masked(text, spans)
                    if sizes:
                        sizes[i] = len(texts[i])
            made = {"text": pa.array(texts, batch.schema.field("text").type)}
            if sizes is not None:
                made["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield with_columns(batch, names, made)

    return docs.mapInArrow(run, docs.schema)
