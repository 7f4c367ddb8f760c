from __future__ import annotations

import hashlib
import random
import re
from pathlib import Path

import pytest

from shopflow.llm import substring_dedup as op
from tests.llm.cases import clashing, corpus, frame, prose


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    big = (1 << 63) - 1
    first: dict[tuple, int] = {}
    for r, w in zip(rows, words):
        for i in range(len(w) - 49):
            window = tuple(w[i : i + 50])
            doc = big if r[0] is None else r[0]
            first[window] = min(first.get(window, big), doc)
    made = []
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < (big if r[0] is None else r[0]):
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        made.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(made, key=repr)


def result(docs):
    return sorted(map(tuple, op.remove_repeats(docs).collect()), key=repr)


def passages(seed=7):
    """Documents that share passages, some with edits, and a text that repeats itself."""
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (50, 51, 60, 90, 200)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(5, 60))]
        for _ in range(rng.randrange(3)):
            some = rng.choice(shared).split(" ")
            if rng.random() < 0.4:
                some[rng.randrange(len(some))] = "edit"
            parts += [" \n".join(some), prose(rng, rng.randrange(30))]
        rows.append((rng.randrange(1000), "\t".join(parts), "en", "a", 1))
    loop = prose(rng, 7)
    rows.append((5000, " ".join([loop] * 30), "en", "a", 1))
    rows.append((5001, "x " + " ".join([loop] * 20), "en", "a", 1))
    rows.append((5002, "\xa0".join(prose(rng, 80).split(" ")), "en", "a", 1))
    return rows


def test_copies_and_odd_rows(spark):
    rows = corpus()
    assert result(clashing(spark, rows)) == brute(rows)


@pytest.mark.parametrize("limit", [1500, 2])
def test_passages(spark, monkeypatch, limit):
    monkeypatch.setattr(op, "SHARD_SEGMENTS", limit)
    rows = passages()
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert result(frame(spark, rows)) == want


def test_automaton_finds_the_smallest_owner():
    rng = random.Random(1)
    texts = [([rng.randrange(3) for _ in range(rng.randrange(1, 30))], rng.randrange(50)) for _ in range(40)]
    automaton = op.SuffixAutomaton()
    for words, owner in texts:
        automaton.add(words, owner)
    automaton.settle()
    for window in (1, 3, 6):
        for words, _ in texts + [([rng.randrange(4) for _ in range(40)], 0) for _ in range(10)]:
            got = automaton.owners(words, window)
            for end in range(len(words)):
                part = words[end + 1 - window : end + 1] if end + 1 >= window else None
                holders = [
                    o
                    for w, o in texts
                    if part and any(w[i : i + window] == part for i in range(len(w) - window + 1))
                ]
                assert got[end] == min(holders, default=op.NOBODY)


def test_anchors_are_gone_before_texts_are_shuffled(spark, monkeypatch):
    """When the texts are joined, the disk holds no row's anchors and no shuffle of them."""
    events, stored, release = [], op.stored, op.release

    def remembered(table, label):
        if label == "substring-affected":
            events.append(label)
            for made in kept:
                assert not made.inputFiles() or not any(Path(f.removeprefix("file:")).exists() for f in made.inputFiles())
        made = stored(table, label)
        events.append(label)
        if "anchors" in made.columns:
            kept.append(made)
        return made

    kept: list = []
    monkeypatch.setattr(op, "stored", remembered)
    monkeypatch.setattr(op, "release", lambda session: events.append("release") or release(session))
    rows = passages()
    assert result(frame(spark, rows)) == brute(rows)
    assert kept and events[events.index("substring-affected") - 1] == "release"


def test_empty_table(spark):
    assert op.remove_repeats(frame(spark, [])).count() == 0
