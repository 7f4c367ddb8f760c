"""Small document tables for the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns whose names operators use themselves
CLASHING = DOCS + ", fp long, k string, row string, size long, words string, row_key string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    found = text.split(" ")
    for _ in range(changes):
        found[rng.randrange(len(found))] = f"x{rng.randrange(1000)}"
    return " ".join(found)


def corpus(seed: int = 3, families: int = 12) -> list[tuple]:
    """Originals with exact and near copies, short, empty, NULL and very long texts."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \t\n", "one", "one two", "ONE two three", "One Two Three"]
    for _ in range(families):
        base = prose(rng, rng.choice([60, 120, 400]))
        texts += [base, base, edited(rng, base, 1), edited(rng, base, 2), edited(rng, base, 12)]
        texts.append(prose(rng, 70) + " " + base[: len(base) // 2])
    texts.append(prose(rng, 20_000))
    texts.append("é" * 50_000)
    rng.shuffle(texts)
    rows = [
        (i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), len(t or ""))
        for i, t in enumerate(texts)
    ]
    rows.append(rows[5])  # a repeated row
    rows.append((rows[6][0], "another text under a used id", "en", "a", 5))
    rows.append((None, rows[9][1], "en", "b", 1))
    return rows


def frame(spark, rows, schema: str = DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    """The rows with extra columns named like the operators' own."""
    wide = [(*r, 1, "k", "row", 2, "words", "key") for r in rows]
    return spark.createDataFrame(wide, CLASHING)
