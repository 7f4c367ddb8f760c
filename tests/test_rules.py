"""Rules the code base keeps."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parents[1] / "shopflow"


@pytest.mark.parametrize(
    "pattern",
    [
        r"crossJoin",
        r"localCheckpoint",
        r"\bbroadcast\(",
        r"\.rdd\b",
        r"@udf|pandas_udf|applyInPandas|mapInPandas",
        r"\.toPandas\(",
        r"collect_(list|set)",
        r"tempfile",
        r"coalesce\(1\)|repartition\(1\)",
    ],
)
def test_not_used(pattern):
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.relative_to(PACKAGE).parts:  # an optional package with rules of its own
            continue
        assert not re.search(pattern, path.read_text()), path
