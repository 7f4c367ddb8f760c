from __future__ import annotations

import random
import re

from shopflow.llm import license_scan as op
from tests.llm.cases import clashing, corpus, frame, prose


def brute(rows):
    found = {}
    for r in rows:
        words = [w for w in re.split(r"[\W_]+", (r[1] or "").lower()) if w]
        shingles = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
        for name, text in op.TEMPLATES.items():
            wanted = set(op.template_shingles(text))
            for at in range(0, len(shingles), len(wanted)):
                share = len(wanted & set(shingles[at : at + 2 * len(wanted)])) / len(wanted)
                if share >= 0.8:
                    best, n, first = found.get((r[0], name), (0, 0, at))
                    found[r[0], name] = (max(best, share), n + 1, min(first, at))
    return sorted(((*k, *v) for k, v in found.items()), key=repr)


def notices(seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(80):
        text = rng.choice(list(op.TEMPLATES.values()))
        if rng.random() < 0.5:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = "  ".join(words).upper()
        rows.append((i, prose(rng, rng.randrange(60)) + " " + text + "\n" + prose(rng, rng.randrange(60)), "en", "a", 1))
    return rows


def test_equals_all_windows(spark):
    rows = notices() + [(1000 + (r[0] or 0), *r[1:]) for r in corpus()] + [(None, "Released under the MIT License.", "en", "a", 1)]
    got = sorted(map(tuple, op.scan(clashing(spark, rows)).collect()), key=repr)
    assert got == brute(rows)
    assert len(got) > 60


def test_no_python_in_the_plan(spark):
    plan = op.scan(frame(spark, notices()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    assert op.scan(frame(spark, [])).count() == 0
