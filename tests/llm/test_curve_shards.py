from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shopflow.llm import curve_shards as op
from tests.llm.cases import clashing, corpus, frame


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_cell_by_single_steps(n, bits):
    cells = np.array(np.meshgrid(*[range(2**bits)] * n)).reshape(n, -1).T
    index = op.hilbert_index(cells, bits)
    order = cells[np.argsort(index)]
    assert sorted(index.tolist()) == list(range(2 ** (bits * n)))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_rows_law(spark):
    rows = corpus()
    got = op.shards(clashing(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    curve = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)


def test_shards_are_narrow_in_every_dimension(spark):
    rng = random.Random(1)
    rows = [
        (i, "x" * rng.randrange(1, 2000), rng.choice("abcdefgh"), f"https://s{rng.randrange(64):02}", 1)
        for i in range(4000)
    ]
    docs = frame(spark, rows)
    got = {r.doc_id: r.shard for r in op.shards(docs).collect()}
    whole = {"lang": 8, "source": 64, "size": 2000}
    spans = {k: [] for k in whole}
    for shard in range(24):
        some = [r for r in rows if got[r[0]] == shard]
        spans["lang"].append(len({r[2] for r in some}) / 8)
        spans["source"].append(len({r[3] for r in some}) / 64)
        lengths = [len(r[1]) for r in some]
        spans["size"].append((max(lengths) - min(lengths)) / 2000)
    for name, shares in spans.items():
        assert sum(shares) / 24 < 0.75, (name, shares)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "a", "en", "s", 1)] * 5])
def test_few_rows(spark, rows):
    got = op.shards(frame(spark, rows)).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(i, 0) for i in range(len(rows))]
