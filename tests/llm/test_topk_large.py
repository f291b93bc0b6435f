"""Components beyond 32 bits, beyond exact doubles, and beyond a long."""

from __future__ import annotations

import numpy as np
import pytest

from headway.llm import topk

from .test_topk import KIND, brute, got


@pytest.mark.parametrize("size", [2.5e6, 3e6, 1e9, 1e12])
def test_large_components_score_exactly(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * size]) for i in range(40)] + [(100, [size, 1.0, -3.0]), (200, [size, 1.0, 3.0]), (300, [1e-3, 2.0, 0.5])]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    cut = [(q, rank, i, min(max(s, topk.LONG[0]), topk.LONG[1])) for q, rank, i, s in brute(rows)]
    assert got(topk.top_k(df)) == cut


def test_the_probe(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.5e6, 0.0]), (2, [1.5e6, 0.0])]
    assert got(topk.top_k(spark.createDataFrame(rows, KIND))) == [(0, 1, 1, 1024 * 2_560_000_000), (0, 2, 2, 1024 * 1_536_000_000)]


def test_close_vectors_far_from_the_origin(spark):
    """Differences of distances keep their digits there."""
    rng = np.random.default_rng(8)
    rows = [(i, (np.array([30_000.0] * 8) + np.round(rng.normal(size=8), 3)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(topk.top_k(df, every=20)) == brute(rows, 10, 20)
