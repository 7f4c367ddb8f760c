"""Conversation repair against exhaustive and plain versions."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest

from shopflow.llm import conversation_repair as repair
from shopflow.llm.conversation_repair import Paths

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Least (cost, audit) over all edits of (initial, fault) rows: shortest path by uniform
    cost search whose queue is ordered by cost, then audit text."""
    queue, done = [(0, "", 0, "z")], set()
    step = {("z", "s"): "s", ("z", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    while queue:
        cost, audit, i, q = heapq.heappop(queue)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in "za":
            return cost, audit
        for role in "ua":
            if (q, role) in step:
                heapq.heappush(queue, (cost + 3, audit + "I", i, step[q, role]))
        if i < len(rows):
            initial, fault = rows[i]
            extra = 3 if fault == 3 else 0
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, q))
            if fault not in (1, 2):
                if (q, initial) in step:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, step[q, initial]))
                for role in "ua":
                    if (q, role) in step:
                        heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, step[q, role]))


def by_paths(rows):
    paths = Paths()
    for row in rows:
        paths.row(*row)
    return paths.result()


def test_least_audit(monkeypatch):
    rng = random.Random(1)
    for block in (256, 3):
        monkeypatch.setattr(repair, "BLOCK", block)
        for _ in range(1500):
            initials = rng.choice(["sua", "ua", "su", "sa", "suax", "a", "u"])
            rows = [(rng.choice(initials), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(11))]
            assert by_paths(rows) == cheapest(rows), rows


def test_long_conversation_keeps_short_integers():
    rng = random.Random(2)
    rows = [(rng.choice("uuas"), rng.choice([0, 0, 0, 1, 3])) for _ in range(6000)]
    paths = Paths()
    for row in rows:
        paths.row(*row)
        assert paths.width < 6 * repair.BLOCK
    assert paths.result() == cheapest(rows)
    assert by_paths([("u", 0)] * 3000)[0] > 0


def plain_version(table):
    """Damage, faults and repair of (conv_id, turn, role, text) rows, one conversation at a time."""

    def text_of(value):
        return " " if value is None else str(value)

    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        rows += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(rows, faults)])
        turns = {r[0] for r in rows} - {None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        odd, made, at = (len(audit) - audit.count("D")) % 2, [], iter(rows)
        for letter in audit:
            row = None if letter == "I" else next(at)
            if letter != "D":
                role = "user" if (len(made) + 1 - odd) % 2 else "assistant"
                made.append(f"{row[1] if letter == 'K' else role}:{row[2] if row else ''}")
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(faults.count(k) for k in (1, 2, 3)),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(made).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def report(table):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r) for r in repair.repair_report(table).select(*names).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "u"]
    texts = ["Yes.", "Why?", "no end", "", " \t\n", None, "dots...  \n", "!", ".", "é?\x0b", "\xa0", "a. b", "x" * 50_000]
    table = []
    for conv in [None, *range(150)]:
        for turn in range(rng.randrange(1, 9)):
            for _ in range(rng.choice([1, 1, 1, 2])):  # several rows of one turn
                role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
                text = f"row {rng.randrange(9)}." if rng.random() < 0.6 else rng.choice(texts)
                table.append((conv, rng.choice([turn, turn, turn, None, turn + 3, -turn]), role, text))
    return table + table[:60]


def test_equals_plain_version(spark, rows):
    assert report(spark.createDataFrame(rows, SCHEMA)) == plain_version(rows)


def test_hot_conversation(spark):
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "user", "assistant", "system"]), f"text {rng.randrange(700)}" + rng.choice(["", ".", "?"]))
            for t in range(1500)]
    rows += [(None, None, "user", "the same.")] * 900 + [(c, 0, "user", "Hi.") for c in range(600)]
    assert report(spark.createDataFrame(rows, SCHEMA)) == plain_version(rows)


def test_repaired_rows_are_well_formed(spark, rows):
    table = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    made = {}
    for r in sorted(repair.repaired(table).collect(), key=lambda r: (repr(r.conv_id), r.place)):
        made.setdefault(r.conv_id, []).append(r)
    digests = {r[0]: r[-1] for r in plain_version(rows)}
    for conv, turns in made.items():
        assert [t.place for t in turns] == list(range(1, len(turns) + 1))
        initials = "".join(t.role[:1] for t in turns)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == digests[conv]


def test_all_rows_dropped(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert report(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


def test_empty_table_and_other_columns(spark, rows):
    assert report(spark.createDataFrame([], SCHEMA)) == []
    table = spark.createDataFrame(rows, SCHEMA)
    wide = table.selectExpr("*", "1 AS dropped", "'x' AS kind", "2 AS copies", "3 AS nth", "'y' AS audit", "4 AS place", "5 AS col")
    assert report(wide) == report(table)
