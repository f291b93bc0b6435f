"""Shares against the weights themselves, not against parts of a period."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction
from itertools import islice

import pytest

from headway.llm import mixing


@pytest.mark.parametrize("weights", [[50_000**0.7] + [5_263**0.7] * 19, [1.0] * 100 + [0.01] * 800, [1e-6, 1.0, 0.3]])
def test_slots_stay_within_a_block_of_the_given_weights(weights):
    exact = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    had = [0] * len(weights)
    turns = mixing.turns(mixing.parts(weights), [10**9] * len(weights))
    for s, turn, slot in islice(turns, 20_000):
        assert turn == had[s]
        had[s] += 1
        if slot % 97 == 0 or slot < 100:
            assert all(abs(h - w * (slot + 1)) < 1 for h, w in zip(had, exact, strict=True))


def test_mix_follows_the_given_weights_over_many_slots(spark):
    docs = spark.range(9004).selectExpr("id AS doc_id", "CASE WHEN id < 4 THEN 'small' ELSE 'hot' END AS source")
    rows = mixing.mix(docs, {"hot": 9996, "small": 4}, block_rows=1).collect()
    had = Counter(r["source"] for r in rows)
    assert abs(had["small"] - len(rows) * 4 / 10_000) < 1
    assert sorted(r["mix"]["slot"] for r in rows) == list(range(len(rows)))


def test_turns_end_when_every_source_is_used_up_once():
    rows = list(mixing.turns([3, 1], [2, 2]))
    assert [s for s, _, _ in rows] == [0, 0, 0, 1] * 2
    assert [(turn, slot) for s, turn, slot in rows if s == 1] == [(0, 3), (1, 7)]
    assert list(mixing.turns([5], [3])) == [(0, 0, 0), (0, 1, 1), (0, 2, 2)]


@pytest.mark.parametrize("small", [3, 65, 130])
def test_rows_follow_the_weights_too(spark, small):
    """A small source's short blocks come in many epochs; its rows keep up with its turns after any slot."""
    docs = spark.range(10_000 + small).selectExpr("id AS doc_id", f"CASE WHEN id < {small} THEN 'small' ELSE 'large' END AS source")
    rows = mixing.mix(docs, {"small": 1, "large": 1}).collect()
    had = Counter((r["mix"]["slot"], r["source"]) for r in rows)
    assert sorted(slot for slot, _ in had) == list(range(len(had)))
    total = Counter()
    for slot in range(len(had)):
        for source in ("small", "large"):
            total[source] += had[slot, source]
            assert -64 < total[source] - 64 * (slot + 1) / 2 < 128
    assert abs(total["small"] / len(rows) - 0.5) < 0.01
    assert max(had.values()) < 128
    mine = sorted((r["mix"]["slot"], r["mix"]["epoch"], r["mix"]["place"], r["doc_id"]) for r in rows if r["source"] == "small")
    order = [m[3] for m in mine]
    assert order == (order[:small] * (1 + len(order) // small))[: len(order)]


def test_many_epochs_of_a_few_rows(spark, monkeypatch):
    """A tiny source of a large weight: its rows come in more epochs than are made at once."""
    monkeypatch.setattr(mixing, "EPOCHS", 10)
    docs = spark.range(1003).selectExpr("id AS doc_id", "CASE WHEN id < 3 THEN 'small' ELSE 'large' END AS source")
    rows = mixing.mix(docs, {"small": 1, "large": 1}, block_rows=1).collect()
    had = Counter(r["source"] for r in rows)
    assert abs(had["small"] - had["large"]) <= 1
    assert sorted(r["mix"]["slot"] for r in rows) == list(range(len(rows)))


def test_many_rows_without_a_key(spark):
    """Copies of one row, and rows that differ, all of a null key."""
    docs = spark.range(4000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'a' AS source", "CASE WHEN id < 3000 THEN 'x' ELSE CAST(id AS STRING) END AS text").repartition(3)
    rows = mixing.mix(docs).collect()
    assert Counter(r["text"] for r in rows if r["mix"]["epoch"] == 0)["x"] == 3000
    assert sorted((r["mix"]["block"], r["mix"]["place"]) for r in rows if r["mix"]["epoch"] == 0) == [(i // 64, i % 64) for i in range(4000)]
