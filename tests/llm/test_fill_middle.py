"""Fill-in-the-middle rewriting against a plain Python version."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pytest

from shopflow.llm import fill_middle
from tests.llm.cases import DOCS, clashing, corpus, frame

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    "a <P> b", "x<S>", "<M>", "<P", "P>", "a <P b> c < S >", "\x00 nul \x00", "\x1c\x1d kept \x85\xa0　 kept",
    "  lead", "trail \t\n", "é è\tü\n\n漢字 😀 x", "\\1 \\0 $1", " ", "\n", "a<" * 30, "w " * 40_000, "\r\n".join("ab"),
]


def rows_of(table):
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return sorted((tuple(r) for r in table.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    odd = [(1000 + 40 * i + k, t, "en", "a", 1) for i, t in enumerate(ODD) for k in range(12)]
    return corpus() + odd + [(None, "no id at all", None, None, None), (None, "another one", None, None, 0)]


def test_equals_plain_version(spark, rows):
    want = sorted((plain_version(r[0], r[1]) for r in rows), key=repr)
    assert rows_of(fill_middle.transform(frame(spark, rows))) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_text_is_restored(spark, rows):
    found = fill_middle.digests(frame(spark, rows)).collect()
    want = sorted((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r.restored_sha256) for r in found if r.doc_id is not None) == want


def test_other_columns_and_empty_table(spark, rows):
    want = rows_of(fill_middle.transform(frame(spark, rows)))
    assert rows_of(fill_middle.transform(clashing(spark, rows))) == want
    named = frame(spark, rows).selectExpr("*", "'x' AS h1", "1 AS n", "'y' AS form", "2 AS output")
    assert rows_of(fill_middle.transform(named)) == want
    assert fill_middle.digests(frame(spark, [], DOCS)).collect() == []


def test_slices_follow_bytes(monkeypatch, spark, rows):
    want = rows_of(fill_middle.transform(frame(spark, rows)))
    batch = pa.RecordBatch.from_pydict({"text": [r[1] for r in rows]})
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 1000)
    parts = list(fill_middle._slices(batch))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p["text"].to_pylist()) <= 1000 for p in parts)
    assert rows_of(fill_middle.transform(frame(spark, rows))) == want
