from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import mixing, queries

from .frames import awkward, documents, empty


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(0.01, 100), min_size=1, max_size=25))
def test_schedule_stays_within_a_block_of_its_shares(weights):
    shares = mixing.parts(weights, 200)
    assert sum(shares) == 200
    assert min(shares) >= 1
    table = mixing.schedule(shares)
    had = [0] * len(shares)
    for t, (s, i) in enumerate(table):
        assert i == had[s]
        assert i * 200 // shares[s] <= t < -(-(i + 1) * 200 // shares[s])
        had[s] += 1
        assert all(abs(200 * had[k] - (t + 1) * shares[k]) < 200 for k in range(len(shares)))
    assert had == shares


def test_parts_refuse_bad_weights():
    for bad in ([1.0, 0.0], [-1.0], [1.0] * 11):
        with pytest.raises(ValueError, match="weights"):
            mixing.parts(bad, 10)


def brute(sources: dict, weights: dict, block_rows: int) -> dict:
    """Of each source: how many blocks it gets, by running the schedule until each one has been used up once."""
    names = sorted(sources, key=lambda k: (k is not None, k))
    shares = mixing.parts([weights[k] for k in names])
    need = [-(-sources[k] // block_rows) for k in names]
    had, slots = [0] * len(names), []
    while any(h < n for h, n in zip(had, need, strict=True)):
        for s, _ in mixing.schedule(shares):
            slots.append(s)
            had[s] += 1
            if all(h >= n for h, n in zip(had, need, strict=True)):
                break
    return {k: slots.count(i) for i, k in enumerate(names)}, [names[s] for s in slots]


@pytest.mark.parametrize("weights", [None, "given"])
def test_mix_follows_the_schedule(spark, sf_dir, weights):
    docs = documents(spark, sf_dir).select("doc_id", "source")
    sizes = Counter(r["source"] for r in docs.collect())
    target = {k: i + 1.0 for i, k in enumerate(sorted(sizes))} if weights else {k: n**mixing.TEMPERATURE for k, n in sizes.items()}
    rows = mixing.mix(docs, target if weights else None, block_rows=4).collect()
    blocks, order = brute(sizes, target, 4)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    by_slot: dict = {}
    for r in rows:
        assert by_slot.setdefault(r["mix"]["slot"], r["source"]) == r["source"]
    assert [by_slot[t] for t in sorted(by_slot)] == order
    assert sorted(by_slot) == list(range(len(order)))
    for source, n in sizes.items():
        mine = sorted((r["mix"]["slot"], r["mix"]["place"], r["doc_id"], r["mix"]["block"], r["mix"]["epoch"]) for r in rows if r["source"] == source)
        assert len({m[0] for m in mine}) == blocks[source]
        first = [m[2] for m in mine if m[4] == 0]
        assert len(first) == len(set(first)) == n
        for epoch in {m[4] for m in mine}:
            again = [m[2] for m in mine if m[4] == epoch]
            assert again == first[: len(again)]
        assert all(m[3] == first.index(m[2]) // 4 and m[1] == first.index(m[2]) % 4 for m in mine)


def test_one_source_of_most_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 100 = 0 THEN 'small' ELSE 'hot' END AS source")
    rows = mixing.mix(docs, {"hot": 3, "small": 1}, block_rows=10).collect()
    slots = {r["mix"]["slot"]: r["source"] for r in rows}
    assert max(Counter(r["mix"]["slot"] for r in rows).values()) == 10
    assert abs(sum(s == "small" for s in slots.values()) - len(slots) / 4) <= 1
    assert len({r["doc_id"] for r in rows}) == 3000


def test_op5(spark, sf_dir):
    rows = queries.op5_mixing(spark, sf_dir)
    assert rows.columns == ["doc_id", "source", "block", "epoch", "slot", "place"]
    assert rows.select("doc_id").distinct().count() == documents(spark, sf_dir).count()


def test_awkward_rows(spark):
    """Null sources are a source; repeated and null keys stay; columns of any name come through."""
    df = awkward(spark, "mix", "_s", "_g", "_row", "a.b")
    rows = mixing.mix(df, block_rows=2).collect()
    first = [r for r in rows if r["mix"]["epoch"] == 0]
    assert len(first) == df.count()
    assert sorted(str(r["text"])[:20] for r in first) == sorted(str(r["text"])[:20] for r in df.collect())
    assert {r["source"] for r in rows} == {None, "a", "b"}
    assert all(r["_s"] == r["_row"] == r["a.b"] == "clash" for r in rows)
    assert mixing.mix(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="weights"):
        mixing.mix(df, {"a": 1})
