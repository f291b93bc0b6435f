from __future__ import annotations

import math

import numpy as np
import pytest

from headway.llm import queries, topk
from tests.compare import same


def brute(rows, k=10, every=100):
    """All scores of all queries."""
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asking: dict = {}
    for i, v in good:
        if i % every == 0:
            asking[i] = min(v, asking.get(i, v))
    out = []
    for q, u in asking.items():
        scores = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), i) for i, v in good if i != q and len(v) == len(u))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect())


KIND = "vec_id long, embedding array<float>"


def test_op10_agrees_with_sql(spark, sf_dir):
    same(queries.op10_topk(spark, sf_dir), queries.oracle_sql()["op10_topk"], sf_dir)


def test_op10_agrees_with_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(queries.op10_topk(spark, sf_dir)) == brute(rows)


def test_several_blocks_and_many_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "STEP", 4)
    rng = np.random.default_rng(2)
    pool = rng.normal(size=(9, 6)).astype(np.float32).astype(float).tolist()
    rows = [(i, pool[int(rng.integers(9))]) for i in range(200)] + [(i, pool[0]) for i in range(200, 300)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    assert got(topk.top_k(df, k=7, every=20)) == brute(rows, 7, 20)


def test_awkward_rows(spark):
    """Nulls, components that are not finite, other lengths, empty vectors, repeated ids, fewer partners than asked for."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [0.5, 9.0]), (100, [1.0, -1.0]), (200, [nan, 1.0]), (300, None), (400, []), (500, [1.0]), (7, [3.0, 4.0]), (7, [3.0, 4.0]), (8, [inf, 0.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [-0.0004, 0.0004]), (11, [])]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "'clash' AS vector", "'clash' AS score", "'clash' AS rank")
    assert got(topk.top_k(df)) == brute(rows)
    assert topk.top_k(spark.createDataFrame([], KIND)).count() == 0
    assert topk.top_k(spark.createDataFrame([(100, [1.0])], KIND)).count() == 0


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_bounds_hold_and_spare_work(spread):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(8, 16)) * 1000
    rows = np.floor(centers[rng.integers(8, size=2000)] + rng.normal(size=(2000, 16)) * 1000 * spread)
    pivots = topk.choose_pivots({16: rows[:500]})[16]
    far, square = topk.distances(rows, pivots).astype(np.float32).astype(float), (rows**2).sum(axis=1)
    scored = 0
    for q in range(0, 2000, 100):
        best = topk.Best(10, -np.inf)
        scored += topk.search_block(best, rows[q], q, far[q], np.arange(2000), rows, far, square)
        scores = rows @ rows[q]
        order = [i for i in np.lexsort((np.arange(2000), -scores)) if i != q][:10]
        assert best.ids.tolist() == order
        assert best.scores.tolist() == scores[order].tolist()
    if spread < 1:
        assert scored < 0.7 * 20 * 2000
