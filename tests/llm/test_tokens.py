from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopflow.llm import packing, token_files
from shopflow.llm.tokens import Encoder
from tests.llm.cases import clashing, corpus, frame

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_equal_whole_texts(path):
    rng = random.Random(2)
    letters = " \t\n\r\x0b\x1c\x85\xa0   aAéßΣς'sdtlv.,!1२́ñ\x01\x00<|>"
    odd = ["".join(rng.choices(letters, k=rng.randrange(50))) for _ in range(4000)]
    odd += ["a<|endoftext|>b", " 's don't  we'll\n\n x", "\n", "", "é" * 300, "a," * 200]
    encode, whole = Encoder(path), Tokenizer.from_file(path)
    for at in range(0, len(odd), 500):
        some = odd[at : at + 500]
        for text, packed in zip(some, encode.encode(some)):
            want = whole.encode(text, add_special_tokens=False).ids + [1]
            assert np.frombuffer(packed, encode.dtype).tolist() == want, ascii(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_columns_equal_whole_texts(path, monkeypatch):
    monkeypatch.setattr("shopflow.llm.tokens.SLICE_BYTES", 300)
    rng = random.Random(5)
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a\n b", "a \n", "\u3000 x y", "é" * 2000, "a b" * 500]
    letters = ["w", "A", "é", "ß", "2", ",", ".", "\n", "\x85", "\u2003", "\x1c", " ", " ", " ", "'s"]
    texts += ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    encode, whole = Encoder(path), Tokenizer.from_file(path)
    batch = pa.RecordBatch.from_pydict({"n": range(len(texts)), "text": pa.array(texts, pa.string())})
    got = [(n, ids) for part, made in encode.encode_batch(batch) for n, ids in zip(part["n"].to_pylist(), made)]
    assert [n for n, _ in got] == list(range(len(texts)))
    for (_, packed), text in zip(got, texts):
        want = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(packed, encode.dtype).tolist() == want, ascii(text)
    assert encode.encode_column(pa.array([], pa.string())) == []


def test_cache_turns_over(monkeypatch):
    monkeypatch.setattr("shopflow.llm.tokens.CACHE_ENTRIES", 20)
    encode, whole = Encoder(BYTE), Tokenizer.from_file(BYTE)
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join(f"w{rng.randrange(60)}," for _ in range(20))
        ids = np.frombuffer(encode.encode([text])[0], encode.dtype).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids + [1]
        assert len(encode.cache) <= 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(100, 140)), max_size=900), st.integers(0, 900), st.integers(0, 900))
def test_blocks_round_trip(ids, a, b):
    payload = token_files.pack(np.array(ids, np.uint32))
    assert token_files.unpack(payload).tolist() == ids
    assert token_files.unpack(payload, a, b).tolist() == ids[a:b]


def test_outliers_do_not_widen_a_block():
    ids = np.full(256, 1000, np.uint32)
    ids[::2] = 1003
    ids[7] = 4_000_000_000
    assert len(token_files.pack(ids)) < 12 + 4 + 7 + 5 + 256 * 2 // 8 + 1


def test_foreign_bytes_are_refused():
    with pytest.raises(ValueError):
        token_files.unpack(b"XXXX" + b"\0" * 20)


@pytest.mark.parametrize("chunk", [1 << 17, 50])
def test_files_hold_every_document(spark, monkeypatch, chunk):
    monkeypatch.setattr(token_files, "CHUNK_IDS", chunk)
    rows = [r for r in corpus() if r[1] != "another text under a used id"]
    rows = [r for r in rows if r[0] is not None]
    got = sorted(map(tuple, token_files.token_files(clashing(spark, rows), WORD).collect()))
    whole = Tokenizer.from_file(WORD)
    want, start = [], 0
    for r in sorted(rows, key=lambda r: r[0]):
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), crc(ids)))
        start += len(ids)
    assert got == sorted(want)


def test_files_with_nulls_and_ties(spark):
    rows = corpus() + [(None, None, "en", "a", 0), (None, "one two", "en", "a", 7)] * 3
    got = token_files.token_files(frame(spark, rows), WORD).collect()
    whole = Tokenizer.from_file(WORD)
    want = Counter()
    for r in rows:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want[r[0], len(ids), crc(ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.doc_id is None or r.doc_id >= last)
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert min(got, key=lambda r: r.start).doc_id is None
    assert token_files.token_files(frame(spark, []), WORD).count() == 0


def test_hot_ids_are_spread(spark):
    """A third of the rows without an id, a third of them one row."""
    ids = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id"))
    hash_ = F.when(F.col("id") % 9 == 0, 7).otherwise(F.xxhash64("id"))
    rows = spark.range(30_000).select(ids.alias("doc_id"), hash_.alias("text_hash"), F.col("id").alias("place"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sizes = sorted(r[1] for r in token_files.in_order(rows).groupBy(F.spark_partition_id()).count().collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 30_000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[3]


def test_plan_fills_all_sequences_but_one():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 2048) for _ in range(400)]
    made = packing.plan(lengths)
    sizes = [sum(n for _, _, n in s) for s in made]
    assert sum(sizes) == sum(lengths) and max(sizes) <= 2048
    assert len(made) == -(-sum(lengths) // 2048)
    pieces = sorted(p for s in made for p in s)
    for item, size in enumerate(lengths):
        at = 0
        for _, start, n in (p for p in pieces if p[0] == item):
            assert start == at
            at += n
        assert at == size


def test_plan_balances_cost():
    lengths = [1024] * 8 + [128] * 64
    costs = [sum(packing.cost(n) for _, _, n in s) for s in packing.plan(lengths)]
    assert max(costs) - min(costs) <= packing.cost(1024)


@pytest.mark.parametrize("bucket", [2 << 20, 3000])
def test_pieces_cover_every_document_once(spark, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_BYTES", bucket)
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = packing.pack(clashing(spark, rows), BYTE).collect()
    whole = Tokenizer.from_file(BYTE)
    ids = {r[0]: whole.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    at = dict.fromkeys(ids, 0)
    for p in sorted(got, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.length > 0
        at[p.doc_id] += p.length
        assert p.ids_crc32 == crc(ids[p.doc_id][p.start : p.start + p.length])
        assert p.doc_tokens == len(ids[p.doc_id])
    assert at == {d: len(v) for d, v in ids.items()}
    sequences: dict[int, int] = {}
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values()) <= 2048


def test_packing_odd_rows(spark):
    """NULL ids, repeated rows and two texts under an id: every piece belongs to one of them."""
    rows = corpus() + [(None, None, "en", "a", 0), (None, "one two", "en", "a", 7)] * 3
    got = packing.pack(frame(spark, rows), BYTE).collect()
    whole = Tokenizer.from_file(BYTE)
    texts = {(r[0], r[1] or ""): whole.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    cuts: dict[tuple, Counter] = {}  # tokens each document's pieces cover, place by place
    for p in got:
        owners = [
            key
            for key, ids in texts.items()
            if key[0] == p.doc_id
            and len(ids) == p.doc_tokens
            and crc(ids[p.start : p.start + p.length]) == p.ids_crc32
        ]
        assert len(owners) == 1, p
        cover = cuts.setdefault(owners[0], Counter())
        cover.update(range(p.start, p.start + p.length))
    repeats = Counter((r[0], r[1] or "") for r in rows)
    assert cuts.keys() == texts.keys()
    for key, cover in cuts.items():
        assert cover == Counter({i: repeats[key] for i in range(len(texts[key]))})
    places = sorted((p.sequence_id, p.offset, p.length) for p in got)
    for (a, at, n), (b, then, _) in zip(places, places[1:]):
        assert then == (at + n if a == b else 0)
    assert packing.pack(frame(spark, []), BYTE).count() == 0


def test_repeated_rows_are_spread(spark):
    """A third of the rows are one row; no bucket holds more than twice the median."""
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
    )
    dealt = packing.pieces(rows, BYTE, 2048, 8).groupBy("bucket").count().collect()
    sizes = sorted(r["count"] for r in dealt)
    assert sum(sizes) == 9_000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[3]
