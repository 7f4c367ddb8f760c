from __future__ import annotations

import random

import numpy as np
import pytest

from shopflow.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int, node long, size string, cell long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def brute(rows, threshold=0.98):
    ok = [
        r[0] is not None and r[2] is not None and r[1] is not None
        and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    vectors = [np.array(r[1], np.float32).astype(float) if k else None for r, k in zip(rows, ok)]
    links, group = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = vectors[i], vectors[j]
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    made = []
    for i, r in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None), default=None)
        made.append((r[0], links[i], least, least is not None and least == r[0]))
    return sorted(made, key=repr)


def vectors(seed=3, dims=16, clusters=25):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for _ in range(clusters):
        centre = rng.normal(size=dims)
        label = int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 12))):
            noise = rng.normal(size=dims) * rng.choice([0, 0.03, 0.08, 0.2])
            scale = rng.choice([1, 1, 3.5])
            rows.append((at, ((centre + noise) * scale).astype(np.float32).tolist(), label))
            at += 1
    rows.append((at, rows[0][1], rows[0][2]))
    rows.append((at + 1, rows[0][1], 1 - rows[0][2]))
    return rows


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1),
    (904, [float("inf")] + [1.0] * 15, 1), (905, [None] + [1.0] * 15, 1), (906, [1.0] * 16, None),
    (907, [1.0] * 8, 1), (908, [1.0] * 8, 1), (None, [1.0] * 16, 1), (909, [1.0] * 16, 1), (909, [1.0] * 16, 1),
    (910, [3e38] * 16, 1), (911, [-0.0] * 15 + [1.0], 1), (912, [0.0] * 15 + [1.0], 1), (913, [2.0], 0), (914, [5.0], 0),
]


@pytest.mark.parametrize("block,queue", [(1024, 4096), (2, 3)])
def test_equals_all_pairs(spark, monkeypatch, block, queue):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "VISITORS", queue)
    rows = vectors() + ODD
    random.Random(1).shuffle(rows)
    got = sorted(map(tuple, op.near_duplicates(table(spark, rows)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[1] for r in got) > 50


def test_traversal_order_and_bound():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    cells = list(op.multi_sequence(a, b, 0.9))
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums)
    assert set(cells) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= 0.9}
    points, centres = rng.normal(size=(300, 5)), rng.normal(size=(12, 5))
    own, bound = op.bounds(points, centres)
    apart = op._squared(points, points)
    for c in range(12):
        inside = np.flatnonzero(own == c)
        if len(inside):
            assert (apart[:, inside].min(axis=1) >= bound[:, c] - 1e-9).all()


def test_vectors_of_one_id(spark):
    """Rows are vectors of their own, also under one id: no shared counts, links among them."""
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (3, [0.02, 1.0], 1),
            (9, [-1.0, 0.0], 1), (4, [-1.0, 0.01], 1), (9, [1.0, 0.0], 2)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op.near_duplicates(table(spark, rows)).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False),
                   (4, 1, 4, True), (9, 0, 9, True), (9, 1, 4, False)]


def test_empty_table(spark):
    assert op.near_duplicates(table(spark, [])).count() == 0
    assert op.near_duplicates(table(spark, ODD[:3])).count() == 3
