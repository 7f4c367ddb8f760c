from __future__ import annotations

import re
from collections import defaultdict

import pytest
import xxhash

from shopflow.llm import simhash
from shopflow.llm.components import connected_components
from tests.llm.cases import clashing, corpus, frame


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    fps = [brute_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g].append(r[0])
    return sorted(
        ((r[0], f"{f:016x}", min(least[g], default=None)) for r, f, g in zip(rows, fps, group)), key=repr
    )


def result(frame_):
    return sorted(map(tuple, simhash.near_duplicates(frame_).collect()), key=repr)


@pytest.mark.parametrize("limit", [1024, 2])
def test_equals_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rows = corpus()
    assert result(clashing(spark, rows)) == brute(rows)


def test_chain_filter_loses_no_close_pair():
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = [int(b) for b in base]
    for b in base:
        for _ in range(8):
            x = int(b)
            for bit in rng.integers(0, 64, 3):
                x ^= 1 << int(bit)
            values.append(x)
    values = np.array(values, np.uint64)
    got = {tuple(p) for s in range(5) for p in simhash._linked(values, s, 5, 2).tolist()}
    want = {
        (i, j)
        for i in range(len(values))
        for j in range(i + 1, len(values))
        if (int(values[i]) ^ int(values[j])).bit_count() <= 2
    }
    assert got == want


def test_edges_join_close_fingerprints(spark):
    import random

    rng = random.Random(4)
    values = []
    for _ in range(30):
        x = rng.getrandbits(64)
        values.append(x)
        for _ in range(4):
            x ^= 1 << rng.randrange(64)
            values.append(x ^ (1 << rng.randrange(64)))
    values = sorted({simhash.signed(v) for v in values})
    fps = spark.createDataFrame([(v, v) for v in values], "fp long, node long")
    found = {r.node: r.component for r in connected_components(simhash.edges(fps)).collect()}
    mask = (1 << 64) - 1
    group = {v: v for v in values}
    for a in values:
        for b in values:
            if ((a ^ b) & mask).bit_count() <= 2 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    assert {v: found.get(v, v) for v in values} == group


def test_one_row_of_each_group_stays(spark):
    rows = [r for r in corpus() if r[1] != "another text under a used id"]
    docs = clashing(spark, rows)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    got = [tuple(r)[:5] for r in kept.collect()]
    components = {c for _, _, c in brute(rows)}
    assert sorted(r[0] for r in got) == sorted(components)
    assert set(got) <= set(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.one_per_group(frame(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(200, 100 + i) for i in range(60)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {i: 0 for i in range(51)} | {
        i: 100 for i in [200, *range(100, 160)]
    }
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
