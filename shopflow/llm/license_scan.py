"""License notices: windows retrieved by MinHash bands, verified by shingle containment.

Words are runs of letters and digits, lower-cased. A template with t distinct 5-word
shingles is looked for in windows of 2t shingles that start every t shingles, so any t
shingles in a row lie in one window. A window holds the template when it has at least
``SIMILARITY`` of its distinct shingles.

**Retrieval.** Windows and templates get ``BANDS`` min-hashes of one row each, from
different linear maps of the shingles' 64-bit hashes. They are candidates when they agree
in any band. A window with the needed share s = 0.8 has a Jaccard similarity to the
template of at least s / (3 - s) = 0.36, so it is missed with a probability of at most
(1 - 0.36) ** 32 < 7e-7. Candidates are verified on the shingles themselves.

A document is cut into chunks of ``CHUNK`` shingles. A chunk that shares no shingle at all
with any template has no window that holds one, so windows are only made in the others;
that test loses nothing. Everything is built from DataFrame functions:
no Python runs on the executors. The templates are a fixed, short list, so they travel as
literals. Texts are not shuffled; only verified windows are grouped by document.

**Edge rows.** NULL, empty or short texts hold nothing. Rows under one doc_id, or without
one, count as one document. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
CHUNK = 256  # shingles
PRIME = (1 << 31) - 1

# Public notices, in their own words
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
}


def template_shingles(text: str) -> list[str]:
    """Distinct shingles of a template, in order."""
    found = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(" ".join(found[i : i + SHINGLE]) for i in range(len(found) - SHINGLE + 1)))


def _maps() -> list[tuple[int, int]]:
    """Multiplier and shift of each band's linear map, from a fixed rule."""
    return [(1 + (7_919 * (b + 1) ** 3) % (PRIME - 1), (104_729 * (b + 1) ** 2) % PRIME) for b in range(BANDS)]


def _min_hashes(hashes: Column) -> Column:
    """One minimum per band; the hashes are folded below 2 ** 31 so that no product overflows."""
    folded = F.transform(hashes, lambda h: F.pmod(h, F.lit(PRIME)))

    def least(a: int, b: int) -> Column:
        return F.array_min(F.transform(folded, lambda h: (h * a + b) % PRIME))

    return F.array(*(least(a, b) for a, b in _maps()))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment, n_windows, first_word: one row per document and template
    it holds, with the best containment, the number of windows that hold the template, and
    the index of the first word of the first such window."""
    known = {n: template_shingles(t) for n, t in sorted((templates or TEMPLATES).items())}
    known = {n: s for n, s in known.items() if s}

    def literals(values: list) -> Column:
        return F.array(*map(F.lit, values))

    def hashed(shingles: list[str]) -> Column:
        return F.transform(literals(shingles), lambda s: F.xxhash64(F.split(s, " ")))

    # the templates' hashes and signatures, once, by the same functions
    made = [F.struct(hashed(s).alias("hashes"), _min_hashes(hashed(s)).alias("signature")) for s in known.values()]
    prepared = dict(zip(known, docs.sparkSession.range(1).select(*made).first()))

    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    worded = docs.select(F.col("doc_id").cast("long"), words.alias("words")).where(F.size("words") >= SHINGLE)
    # chunks of shingles, each with what its last windows reach over its end
    longest = max(map(len, known.values()))
    reach = CHUNK + 2 * longest + SHINGLE - 1
    n = F.size("words") - (SHINGLE - 1)
    chunk = F.transform(
        F.sequence(F.lit(0), n - 1, F.lit(CHUNK)),
        lambda at: F.struct(at.alias("start"), n.alias("n"), F.slice("words", at + 1, reach).alias("words")),
    )
    chunks = worded.select("doc_id", F.explode(chunk).alias("c")).select("doc_id", "c.*")
    starts = F.sequence(F.lit(1), F.size("words") - (SHINGLE - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, SHINGLE)))
    every = sorted({h for p in prepared.values() for h in p["hashes"]})
    touched = chunks.withColumn("hashes", hashes).where(F.arrays_overlap("hashes", literals(every)))

    def windows(name: str, shingles: list[str]) -> Column:
        t = len(shingles)
        first = F.ceil(F.col("start") / t).cast("int") * t  # windows start at multiples of t
        places = F.transform(F.sequence(F.lit(0), F.lit(CHUNK // t)), lambda k: first + k * t)
        places = F.filter(places, lambda at: (at < F.col("start") + CHUNK) & (at < F.col("n")))
        return F.transform(
            places,
            lambda at: F.struct(
                F.lit(name).alias("license"),
                F.lit(t).alias("t"),
                at.alias("at"),
                F.slice("words", at - F.col("start") + 1, 2 * t + SHINGLE - 1).alias("words"),
                F.slice("hashes", at - F.col("start") + 1, 2 * t).alias("hashes"),
            ),
        )

    cut = touched.select("doc_id", F.explode(F.concat(*(windows(n, s) for n, s in known.items()))).alias("w"))
    cut = cut.select("doc_id", "w.*")

    def by_license(values: dict[str, list]) -> Column:
        return F.element_at(F.create_map(*(c for n, v in values.items() for c in (F.lit(n), literals(v)))), F.col("license"))

    own = _min_hashes(F.col("hashes"))
    theirs = by_license({n: p["signature"] for n, p in prepared.items()})
    agree = F.exists(F.zip_with(own, theirs, lambda a, b: a == b), lambda x: x)
    candidates = cut.where(agree)
    inside = F.transform(
        F.sequence(F.lit(1), F.size("words") - (SHINGLE - 1)), lambda i: F.array_join(F.slice("words", i, SHINGLE), " ")
    )
    shared = F.size(F.array_intersect(inside, by_license(known)))
    verified = candidates.select("doc_id", "license", "at", (shared / F.col("t")).alias("containment"))
    return (
        verified.where(F.col("containment") >= SIMILARITY)
        .groupBy("doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.count(F.lit(1)).alias("n_windows"),
            F.min("at").cast("long").alias("first_word"),
        )
    )


def oracle_sql() -> str:
    """The same result by comparing every window with every template."""
    rows = ", ".join(
        f"('{n}', [{', '.join(repr(s) for s in template_shingles(t))}])" for n, t in sorted(TEMPLATES.items())
    )
    return rf"""
WITH template(license, wanted) AS (VALUES {rows}),
worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words
  FROM documents),
shingled AS (
  SELECT doc_id, list_transform(range(1, len(words) - {SHINGLE - 2}),
                                lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' ')) AS shingles
  FROM worded WHERE len(words) >= {SHINGLE}),
cut AS (
  SELECT doc_id, license, wanted, pos,
         list_intersect(wanted, shingles[pos + 1:pos + 2 * len(wanted)]) AS shared
  FROM shingled, template, unnest(range(0, len(shingles), len(wanted))) AS starts(pos)
  WHERE list_has_any(shingles, wanted))
SELECT doc_id, license, max(len(shared)::DOUBLE / len(wanted)) AS containment, count(*) AS n_windows,
       min(pos) AS first_word
FROM cut WHERE len(shared)::DOUBLE / len(wanted) >= {SIMILARITY} GROUP BY doc_id, license
"""
