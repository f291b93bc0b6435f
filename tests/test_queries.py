from __future__ import annotations

import pytest

import __spark_entry__ as entry
from headway.plans import queries as core
from tests.compare import same


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    same(core.QUERIES[name](spark, sf_dir), core.ORACLES[name], sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_imports_the_optional_subpackage():
    from pathlib import Path

    root = Path(core.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
