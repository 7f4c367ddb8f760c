from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

from shopflow.llm import mixing
from shopflow.llm.queries import MIX_SQL
from tests.llm.cases import clashing, corpus, frame


def want(rows):
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("frame", documents)
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM frame")
    return sorted(con.execute(MIX_SQL).fetchall(), key=repr)


def result(docs):
    return sorted(map(tuple, mixing.mix(docs).collect()), key=repr)


def water(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


@pytest.mark.parametrize("rows_in_range", [20_000, 3])
def test_equals_sql(spark, monkeypatch, rows_in_range):
    monkeypatch.setattr(mixing, "RANGE_ROWS", rows_in_range)
    rows = corpus()
    got = result(clashing(spark, rows))
    assert got == want(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split(" ")) if (r[1] or "").strip() else 0


def test_targets_and_budgets(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        source = rng.choice(["a"] * 30 + ["b", "c", "d", "é", None])
        rows.append((i, "w " * rng.randrange(40), "en", source, 1))
    got = {r[0]: r for r in result(frame(spark, rows))}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        _, size, source_size, aim, words = got[r[0]]
        sizes[r[3]] += size
        taken[r[3]] += words
        target[r[3]] = aim
        assert 0 <= words <= 3 * size
    for s, aim in water(sizes).items():
        assert target[s] == pytest.approx(aim)
        assert taken[s] == round(aim)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), abs=6)


def test_whole_documents(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "abc"[i % 3], 1) for i in range(90)]
    mixed = mixing.mixed_documents(clashing(spark, rows))
    times = Counter(r.doc_id for r in mixed.collect())
    for doc_id, size, _, _, taken in result(frame(spark, rows)):
        assert times[doc_id] == -(-taken // size)
    assert mixed.columns == clashing(spark, rows).columns


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, 0)], [(1, "", "en", "a", 0), (2, " ", "en", None, 0)]])
def test_nothing_to_mix(spark, rows):
    assert [r[3:] for r in result(frame(spark, rows))] == [(0.0, 0)] * len(rows)
    assert mixing.mixed_documents(frame(spark, rows)).count() == 0
