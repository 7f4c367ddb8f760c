"""Repair of conversation structure by the cheapest edits, the least audit among equals.

A repaired conversation has role initials ``(s?(ua)+)?``. Rows are kept (0), given the other
role (3), deleted (4; blank and repeated rows always are) or inserted with an empty text (3);
a truncated row that stays adds 3. The edits in order, one letter each, are the audit.

**Decision.** Paths through the rows form a directed acyclic graph over (rows read, last role,
letters written). A path's weight is one big integer: its cost in the digits above ``width``,
and below them one base-8 digit per letter at the letter's place, zero behind the last. Least
integer means least cost and then least audit, an audit being less than its continuations, so
a plain minimum per node decides everything and the audit is read off the winner's digits.
Two paths of equal cost that have read the same rows and end in the same role never have
audits of which one begins the other (the longer one would have paid for its insertions), so
their order never changes later and one node per last role is enough at each row.

Digits that all living paths share are written out after every ``BLOCK`` rows, and paths that
can no longer win are dropped, so the integers stay short in a conversation of any length.

**On Spark.** One shuffle by conversation for the decision, one for its execution. Rows stream
through in order; a task holds the paths, never the rows of a conversation. Which rows repeat
an earlier one is a window over (conversation, role, text), whose sort spills. A conversation
is read by one task whatever its size: an audit and a SHA-256 of one conversation are serial
by definition. The task's memory does not grow with the texts.

Defined results: a NULL conversation id is a conversation. NULL roles and texts are one space,
NULL turns come first. Rows of one turn follow role, then text, in byte order. A role's initial
is its first character, an empty role has none and can only be deleted or given a role. Extra
columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# fixed values: white space, sentence ends, damage by remainder
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
KINDS = 20

BLOCK = 256

_START, _S, _U, _A = range(4)
_D, _I, _K, _R = 1, 2, 3, 4  # digits in the letters' ASCII order
_LETTERS = str.maketrans("1234", "DIKR")
_INSERTS = ((_START, _U), (_S, _U), (_A, _U), (_U, _A))
_NEXT = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_REROLED = {_START: _U, _S: _U, _A: _U, _U: _A}
_FINE, _BLANK, _DUPLICATE, _CUT = range(4)

DECISION = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class Paths:
    """The least path to each last role, row by row."""

    def __init__(self) -> None:
        self.written: list[str] = []  # digits that all paths share
        self._open({_START: (0, "")})

    def _open(self, paths: dict[int, tuple[int, str]]) -> None:
        # a row adds three letters at most: two insertions and its own
        self.width = max(len(d) for _, d in paths.values()) + 3 * BLOCK + 2
        self.unit = 1 << 3 * self.width
        self.nodes = {
            q: (cost * self.unit + (int(d.ljust(self.width, "0"), 8)), len(d))
            for q, (cost, d) in paths.items()
        }
        self.rows = 0

    def _digits(self, node: tuple[int, int]) -> str:
        return f"{node[0] % self.unit:0{self.width}o}"[: node[1]]

    def _flush(self) -> None:
        paths = {q: (v[0] // self.unit, self._digits(v)) for q, v in self.nodes.items()}
        shared = len(commonprefix([d for _, d in paths.values()]))
        self.written.append(next(iter(paths.values()))[1][:shared])
        self._open({q: (cost, d[shared:]) for q, (cost, d) in paths.items()})

    def _longer(self, node: tuple[int, int], cost: int, digit: int) -> tuple[int, int]:
        value, letters = node
        return value + cost * self.unit + (digit << 3 * (self.width - 1 - letters)), letters + 1

    def _insert(self) -> None:
        """Up to two insertions: more in a row only return to where they began."""
        for _ in range(2):
            nodes = dict(self.nodes)
            for p, q in _INSERTS:
                if p in self.nodes:
                    made = self._longer(self.nodes[p], INSERT, _I)
                    if q not in nodes or made < nodes[q]:
                        nodes[q] = made
            self.nodes = nodes
        ended = self.nodes[_A][0] // self.unit
        # after "a" all is possible that is after the start or "s", except to take an "s" row
        if _START in self.nodes and self.nodes[_START][0] // self.unit > ended + DELETE:
            del self.nodes[_START]
        if _S in self.nodes and self.nodes[_S][0] // self.unit > ended:
            del self.nodes[_S]

    def row(self, initial: str, fault: int) -> None:
        if self.rows == BLOCK:
            self._flush()
        self.rows += 1
        self._insert()
        extra = TRUNCATED if fault == _CUT else 0
        nodes = {q: self._longer(node, DELETE, _D) for q, node in self.nodes.items()}
        if fault not in (_BLANK, _DUPLICATE):
            for q, node in self.nodes.items():
                for to, cost, digit in (
                    (_NEXT.get((q, initial)), extra, _K),
                    (_REROLED[q], REROLE + extra, _R),
                ):
                    if to is not None:
                        made = self._longer(node, cost, digit)
                        if to not in nodes or made < nodes[to]:
                            nodes[to] = made
        self.nodes = nodes

    def result(self) -> tuple[int, str]:
        self._insert()
        best = min(self.nodes[q] for q in (_START, _A) if q in self.nodes)
        digits = "".join(self.written) + self._digits(best)
        return best[0] // self.unit, digits.translate(_LETTERS)


class _Conversation:
    """What one conversation's rows, in order, add up to."""

    def __init__(self) -> None:
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.paths = Paths()

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        self.paths.row(initial, fault)

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults[1:], self.illegal, *self.paths.result())


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as damaged by the contract's rule, with ``dropped``: rows that are gone and
    only name their conversation."""
    space = F.lit(" ")

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % KINDS
    text = filled("text")
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(filled("role")).alias("role"),
        F.when(kind.isin(0, 1), "")
        .when(kind == 2, F.translate(text, "".join(ENDS), ""))
        .otherwise(text)
        .alias("text"),
        (kind == 0).alias("dropped"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.select(
        "conv_id", "turn", "role", "text", "dropped", F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    ).drop("col")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    order = [F.col(name).asc_nulls_first() for name in ("conv_id", *first, "turn")]
    return rows.sortWithinPartitions(*order, "role", "text")


def decide(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts, the cost of the cheapest edits and their audit.

    ``rows``: conv_id, turn, role, text without NULL roles and texts, and ``dropped``.
    """
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(bare == "", _BLANK)
        .when(F.col("nth") > 1, _DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(*ENDS), _CUT)
        .otherwise(_FINE)
    )
    # rows that are gone are no earlier rows: they are blank, and blank rows come first anyway
    dealt = rows.select("conv_id", "turn", "role", "text", "dropped").repartition("conv_id")
    ready = _in_order(dealt.withColumn("nth", F.row_number().over(seen))).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "dropped"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(c)) for c in zip(*done)]
            arrays = [columns[0].cast(kind), *(c.cast(pa.int64()) for c in columns[1:-1]), columns[-1]]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_COUNTS])

        for batch in batches:
            kind = batch.column("conv_id").type
            for conv, turn, initial, fault, dropped in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, *now.result()))
                    now, key = _Conversation(), conv
                if not dropped:
                    now.row(turn, initial, fault)
            if done:
                yield out()
                done.clear()
        if now is not None:
            done.append((key, *now.result()))
            yield out()

    return ready.mapInArrow(run, f"conv_id {_kind(rows)}, {DECISION}")


def _kind(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


class _Replay:
    """Carries out one conversation's audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # only then it begins with an "s" row

    def _role(self) -> str:
        self.place += 1
        return "user" if (self.place - self.odd) % 2 else "assistant"

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            role = self._role()
            yield self.place, "Insert", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            new = self._role()
            yield (self.place, "Keep", role, text) if letter == "K" else (self.place, "Rerole", new, text)


_REPAIRED = "place long, edit string, role string, text string"


def _replayed(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every conversation's decision at place 0, its repaired rows behind it, in order."""
    none = F.lit(None)
    heads = decisions.select(
        "conv_id", F.lit(0).alias("part"), none.cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), *_COUNTS,
    )
    types = {f.name: f.dataType for f in decisions.schema.fields}
    body = rows.where(~F.col("dropped")).select(
        "conv_id", F.lit(1).alias("part"), F.col("turn").cast("long"), "role", "text",
        *(none.cast(types[c]).alias(c) for c in _COUNTS),
    )
    kind = _kind(decisions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = key = None
        for batch in batches:
            made: list[tuple] = []
            heads: list[tuple] = []  # (place in made, row of the batch)
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "role", "text", "audit")]
            for i, (conv, part, role, text, audit) in enumerate(zip(*columns)):
                if part == 0:
                    if replay is not None:
                        made += [(key, *r) for r in replay.inserted()]
                    replay, key = _Replay(audit), conv
                    heads.append((len(made), i))
                    made.append((conv, 0, None, None, None))
                else:
                    made += [(key, *r) for r in replay.row(role, text)]
            if made:
                yield out(made, heads, batch)
        if replay is not None and (made := [(key, *r) for r in replay.inserted()]):
            yield out(made, [], batch)

    def out(made: list[tuple], heads: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        source: list[int | None] = [None] * len(made)
        for at, row in heads:
            source[at] = row
        take = pa.array(source, pa.int64())
        conv, place, edit, role, text = (list(c) for c in zip(*made))
        arrays = [
            pa.array(conv, batch.column("conv_id").type),
            pa.array(place, pa.int64()),
            *(pa.array(c, pa.string()) for c in (edit, role, text)),
            *(batch.column(c).take(take) for c in _COUNTS),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "place", "edit", "role", "text", *_COUNTS])

    dealt = heads.unionByName(body).repartition("conv_id")
    return _in_order(dealt, "part").mapInArrow(run, f"conv_id {kind}, {_REPAIRED}, {DECISION}")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), edit, role, text."""
    both = _replayed(rows, decide(rows)).where(F.col("place") > 0)
    return both.select("conv_id", "place", "edit", "role", "text")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's columns: every conversation's counts, cost and audit after the damage,
    and the SHA-256 of its repaired rows, hashed in passing behind their replay."""
    rows = damaged(conversations)
    replayed = _replayed(rows, decide(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = digest = None
        first = True
        for batch in batches:
            heads, digests = ([], []) if head is None else ([head], [])
            columns = (batch.column(c).to_pylist() for c in ("place", "role", "text"))
            for i, (place, role, text) in enumerate(zip(*columns)):
                if place == 0:
                    if digest is not None:
                        digests.append(digest.hexdigest())
                    head, digest, first = batch.slice(i, 1).select(["conv_id", *_COUNTS]), hashlib.sha256(), True
                    heads.append(head)
                else:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if digests:
                yield out(heads[: len(digests)], digests)
        if digest is not None:
            yield out([head], [digest.hexdigest()])

    def out(heads: list[pa.RecordBatch], digests: list[str]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(digests, pa.string())], names=["conv_id", *_COUNTS, "repaired_sha256"]
        )

    return replayed.mapInArrow(run, f"conv_id {_kind(conversations)}, {DECISION}, repaired_sha256 string")


def _oracle() -> str:
    """A recursion over each conversation's rows. A path is its cost in nine digits and its
    audit, as text: text order is cost, then audit. '~' is no path."""

    def longer(path: str, cost: str, letter: str) -> str:
        return (
            f"CASE WHEN {path} = '~' THEN '~' ELSE "
            f"lpad((left({path}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({path}, 10) || '{letter}' END"
        )

    def inserted(source: str) -> str:
        p = {q: longer(q, str(INSERT), "I") for q in "zsua"}
        return (
            f"SELECT * REPLACE (least(u, {p['z']}, {p['s']}, {p['a']}) AS u, least(a, {p['u']}) AS a) FROM {source}"
        )

    def dropped(path: str) -> str:
        return longer(path, str(DELETE), "D")

    def taken(path: str, initial: str, letter: str, cost: int, source: str) -> str:
        free = "NOT gone" + (f" AND initial = '{initial}'" if letter == "K" else "")
        return f"CASE WHEN {free} THEN {longer(source, f'{cost} + extra', letter)} ELSE '~' END"

    def to_user(source: str) -> str:
        return f"{taken('u', 'u', 'K', 0, source)}, {taken('u', 'u', 'R', REROLE, source)}"

    return rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
bits AS (
  SELECT *, flatten(list_transform(range(1, length(key) + 1), lambda i:
           list_transform(range(0, 8), lambda b: (ascii(substr(key, i::INT, 1))::BIGINT >> b::INT) & 1))) AS bits FROM c),
k AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda r, b:
           xor(r >> 1, 3988292384::BIGINT * (xor(r, b) & 1))), 4294967295::BIGINT) % 20 AS kind FROM bits),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
r AS (
  SELECT *, bare = '' OR again AS gone,
         CASE WHEN bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS extra FROM f),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (bare = '') AS blank, count(*) FILTER (bare <> '' AND again) AS duplicate,
         count(*) FILTER (extra > 0) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n FROM r GROUP BY conv_id),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS z, '~' AS s, '~' AS u, '~' AS a FROM counts
  UNION ALL
  SELECT conv_id, i,
         {dropped('z')}, least({dropped('s')}, {taken('s', 's', 'K', 0, 'z')}),
         least({dropped('u')}, {to_user('z')}, {to_user('s')}, {to_user('a')}),
         least({dropped('a')}, {taken('a', 'a', 'K', 0, 'u')}, {taken('a', 'a', 'R', REROLE, 'u')})
  FROM ({inserted('(' + inserted("(SELECT p.conv_id, r.i, z, s, u, a, initial, gone, extra FROM paths p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1)") + ')')})),
ends AS (
  SELECT p.conv_id, least(z, a) AS best
  FROM ({inserted('(' + inserted("(SELECT paths.* FROM paths JOIN counts ON counts.conv_id IS NOT DISTINCT FROM paths.conv_id AND i = n)") + ')')}) p),
letters AS (
  SELECT conv_id, substr(best, 10) AS audit, unnest(range(1, length(best) - 8)) AS pos FROM ends),
edits AS (
  SELECT conv_id, pos, audit[pos] AS letter,
         sum((audit[pos] <> 'I')::INT) OVER w AS row, sum((audit[pos] <> 'D')::INT) OVER w AS place,
         length(replace(audit, 'D', '')) % 2 AS odd
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
made AS (
  SELECT e.conv_id, string_agg(
           CASE WHEN letter = 'K' THEN r.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN letter = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY pos) AS rows
  FROM edits e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.row
  WHERE letter <> 'D' GROUP BY e.conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(left(best, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit,
       sha256(coalesce(made.rows, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN made ON made.conv_id IS NOT DISTINCT FROM q.conv_id
"""


ORACLE_SQL = _oracle()
