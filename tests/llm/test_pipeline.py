"""The five stages in order, each judged on what its predecessor kept."""

from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pytest
import tokenizers
import xxhash

import corpus_pipeline
from tests.llm.cases import DOCS, clashing, corpus, frame

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [found[i : i + 3] for i in range(len(found) - 2)] or ([found] if found else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Number of components of fingerprints at most two bits apart."""
    left, n = set(prints), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            at = todo.pop()
            near = {p for p in left if (p ^ at).bit_count() <= 2}
            left -= near
            todo += near
    return n


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows each stage was given and returned, over odd rows with clashing columns."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    now, made = clashing(spark, corpus()), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/{i}")
        out = spark.read.parquet(f"{folder}/{i}")
        made.append((now, out))
        now = out
    return made


def rows(table):
    return Counter(tuple(r) for r in table.select(*COLUMNS).collect())


def test_stages_return_the_columns_of_documents(stages):
    for _, out in stages[:-1]:
        assert out.columns[:5] == COLUMNS and set(out.columns) >= set(COLUMNS)


def test_quality_removes_whole_rows_and_all_short_ones(stages):
    given, kept = map(rows, stages[0])
    assert kept and not kept - given
    assert all(len(words(r[1])) >= 50 for r in kept)


def test_one_document_of_each_group_stays(stages):
    given, kept = map(rows, stages[1])
    assert kept and not kept - given
    prints = {r[1]: fingerprint(r[1]) for r in given}
    assert sum(kept.values()) == groups(prints.values()) == groups(prints[r[1]] for r in kept)


def test_masking_keeps_every_document(stages):
    given, kept = map(rows, stages[2])
    assert Counter(r[0] for r in given.elements()) == Counter(r[0] for r in kept.elements())


def test_the_mix_holds_whole_documents_of_its_input(stages):
    given, mixed = map(rows, stages[3])
    assert mixed and set(mixed) <= set(given)
    assert all(n <= 3 * given[r] for r, n in mixed.items())


def test_sequences_hold_every_token_of_the_mix(stages):
    mixed, packed = stages[4]
    model = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want, got = Counter(), Counter()
    for r in mixed.collect():
        want[r.doc_id] += len(model.encode(r.text or "", add_special_tokens=False).ids) + 1
    filled = {}
    for r in packed.collect():
        got[r.doc_id] += r.length
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for held in filled.values():
        ends = [0] + [offset + length for offset, length in sorted(held)]
        assert [offset for offset, _ in sorted(held)] == ends[:-1] and ends[-1] <= 2048


def test_an_empty_table_runs_through(spark, tmp_path):
    frame(spark, [], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
