"""The registered queries over sf0.01, and the rules of the package."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from shopflow.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.01"
PACKAGE = Path(__file__).resolve().parents[2] / "shopflow"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("pattern", ["crossJoin", "localCheckpoint", "tempfile", r"\.rdd\b", "except ImportError", r"coalesce\(1\)"])
def test_not_used(pattern):
    for path in [*(PACKAGE / "llm").glob("*.py"), PACKAGE.parent / "corpus_pipeline.py"]:
        assert not re.search(pattern, path.read_text()), path


def test_nothing_else_imports_the_package():
    for path in PACKAGE.rglob("*.py"):
        if "llm" not in path.relative_to(PACKAGE).parts:
            assert "llm" not in path.read_text(), path
