"""Token ids of whole texts with a public tokenizer file, one cache of pieces per worker.

Both supported files cut a text before they merge anything: at white space, and between a
word and a full stop or comma that ends it. So a text's ids are the ids of its pieces, one
after the other, and most pieces were seen before: their ids come from a dictionary of
bounded size. A new word of Latin letters is a single unit for the tokenizer's model and
goes to it directly; any other new piece is encoded as a text. The result equals
``Tokenizer.encode(text, add_special_tokens=False)`` for every text.

A column of texts is cut at its spaces by Arrow kernels, and every distinct part of a slice
of ``SLICE_BYTES`` is looked up once. Where white space becomes tokens, a part carries the
space before it; a text with other white space beside a space is cut by the pattern alone.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 1_000_000
LONGEST_CACHED = 48
SLICE_BYTES = 16 << 20
END = 1

# Unicode White_Space, as the tokenizers' own patterns understand \s
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_WORD = f"[{_LETTER}]+(?=[{_SPACE}.,]|\\Z)"
_STOPS = f"[.,]+(?=[{_SPACE}]|\\Z)"
_IS_WORD = re.compile(f" ?[{_LETTER}]+")
_SPACED = re.compile(f"[{_SPACE}]|.*[{_SPACE}]\\Z|\\Z", re.DOTALL)  # white space at an end, or nothing


def _byte_letters() -> dict[int, str]:
    """The visible characters by which byte-level models write bytes: a printable Latin-1
    character stands for itself, the others follow from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Pieces(dict):
    """Packed ids by piece, in two generations; a piece in use moves to the younger one."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Token ids as packed unsigned integers of ``dtype``."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.end = self._packed([END])
        letters = _byte_letters()
        self.space = letters[32]
        self.shown = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}
        self.spaces_count = self._ids("a b") != self._ids("a  b")  # white space becomes tokens
        if self.spaces_count:
            self.pieces = re.compile(f" ?{_WORD}|{_STOPS}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
        else:
            self.pieces = re.compile(f"{_WORD}|{_STOPS}|[^{_SPACE}]+")
        self.lower = self._ids("AB") == self._ids("ab")
        self.cache = _Pieces(self._make)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _make(self, piece: str) -> bytes:
        if _IS_WORD.fullmatch(piece):
            word = piece.lower() if self.lower else piece
            if not word.isascii():
                word = word.translate(self.shown)
            if word[0] == " ":
                word = self.space + word[1:]
            return self._packed([t.id for t in self.model.tokenize(word)])
        return self._packed(self._ids(piece))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text, with the end id after them."""
        get, find, end = self.cache.__getitem__, self.pieces.findall, self.end
        return [b"".join(map(get, find(text))) + end for text in texts]

    def _part(self, part: str) -> bytes:
        """The packed ids of a text between two cuts."""
        ids = self.cache.get(part)
        if ids is None:
            found = self.pieces.findall(part)
            ids = self.cache[part] if len(found) == 1 else b"".join([self.cache[p] for p in found])
        return ids

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """As ``encode``, for a column; NULL is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        cut = pc.split_pattern(texts, " ")
        ends = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        at = coded.indices.to_numpy().copy()
        parts = coded.dictionary.to_pylist()
        alone = np.zeros(len(texts), bool)
        if self.spaces_count:
            apart = np.fromiter((_SPACED.match(p) is not None for p in parts), bool, len(parts))
            alone[np.searchsorted(ends, np.flatnonzero(apart[at]), "right") - 1] = True
            first = [parts[i] for i in at[ends[:-1]].tolist()]  # no space before it
            at[ends[:-1]] = np.arange(len(parts), len(parts) + len(first))
            parts = [" " + p for p in parts] + first
        ids = pa.array(map(self._part, parts), pa.large_binary()).take(pa.array(at))
        offsets = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[ends].tolist()
        data = ids.buffers()[2]
        data = memoryview(data) if data else memoryview(b"")
        made = [bytes(data[a:b]) + self.end for a, b in zip(offsets, offsets[1:])]
        for i in np.flatnonzero(alone).tolist():
            made[i] = self.encode([texts[i].as_py()])[0]
        return made

    def encode_batch(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        """Slices of a batch whose ``text`` takes about ``SLICE_BYTES``, and their packed ids."""
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        home = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(home)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                part = batch.slice(a, b - a)
                yield part, self.encode_column(part.column("text"))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it stays for the worker's later tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
