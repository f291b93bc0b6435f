"""Queries against their SQL, on the smallest and the next larger tables."""

from __future__ import annotations

import pytest

from headway.llm import queries
from tests.compare import same

from .test_language import larger


@pytest.mark.parametrize("name", ["op5_mixing", "quality_base_counts", "pii_base_spans"])
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    for path in dict.fromkeys((sf_dir, larger(sf_dir))):
        same(queries.queries()[name](spark, path), queries.oracle_sql()[name], path)
