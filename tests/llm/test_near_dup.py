from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import near_dup, queries, textkit
from headway.llm.common import told
from headway.llm.components import UnionFind, components
from headway.llm.superminhash import signatures

from .frames import awkward, documents, empty


def shingle_set(text: str | None, size: int) -> frozenset:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows: list[tuple[int, str | None]], size: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) by all pairs that share a shingle."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    shared: dict[tuple[int, int], int] = defaultdict(int)
    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                shared[j, i] += 1
            holders[s].append(i)
    uf = UnionFind()
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            uf.union(i, j)
    return {i: (len(sets[i]), uf.find(i)) for i in sets}


def check(df, expected):
    got = {r["doc_id"]: r for r in df.collect()}
    assert set(got) == set(expected)
    for i, (n, component) in expected.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, component, i == component)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbBÉé \t\n\x0b .", max_size=30)), max_size=12), st.integers(1, 4))
def test_shingles_are_those_of_the_words(texts, size):
    sets, bounds = textkit.shingles(textkit.words(pa.array(texts, pa.string()), lower=True), size)
    assert np.diff(bounds).tolist() == [len(shingle_set(t, size)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            same = np.array_equal(sets[bounds[i] : bounds[i + 1]], sets[bounds[j] : bounds[j + 1]])
            assert same == (shingle_set(a, size) == shingle_set(b, size))


@pytest.mark.parametrize("n", [2, 10, 100, 3000])
def test_signatures_estimate_similarity_with_less_variance(n):
    rng = np.random.default_rng(n)
    registers, found = 160, []
    for _ in range(150):
        u = rng.integers(0, 1 << 62, 2 * n, dtype=np.uint64)
        shared = n - n // 4
        a, b = u[:n], np.concatenate([u[:shared], u[n : 2 * n - shared]])
        s = signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]), registers)
        found.append((s[0] == s[1]).mean())
    j = shared / (2 * n - shared)
    spread = (j * (1 - j) / registers) ** 0.5
    assert abs(np.mean(found) - j) < 4 * max(spread, 1e-9) / 150**0.5 + 1e-9
    assert np.std(found) < 1.15 * spread + 1e-9


def test_equal_and_empty_sets():
    s = signatures(np.array([1, 2, 3, 3, 2, 1], np.uint64), np.array([0, 3, 3, 6]), 64)
    assert (s[0] == s[2]).all()
    assert (s[1] == s[1].max()).all()


@pytest.mark.parametrize(("size", "name"), [(2, "contract"), (5, "default")])
def test_components_are_those_of_all_pairs(spark, sf_dir, size, name):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf_dir).collect()]
    p = near_dup.NearDup(words=size) if name == "contract" else near_dup.NearDup()
    check(near_dup.near_duplicates(documents(spark, sf_dir), p), brute(rows, size))


def test_op3(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf_dir).collect()]
    check(queries.op3_near_dup(spark, sf_dir), brute(rows, 2))


def test_a_hot_group_of_near_copies_in_small_blocks(spark):
    """One base text, of which 150 copies differ in 1 to 9 words; leaders do not reach all, and blocks are small."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(120, rng.integers(1, 10), replace=False):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p = near_dup.NearDup(words=2, block_members=16, block_shingles=2000)
    check(near_dup.near_duplicates(df, p), brute(rows, 2))


def test_awkward_rows(spark):
    df = awkward(spark, "rep", "component", "sig", "key", "n_shingles", "kept")
    got = near_dup.near_duplicates(df, near_dup.NearDup(words=2)).collect()
    assert len(got) == df.count()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(tuple(r))
    assert by[1] == [(1, 13, 1, True)] * 2
    for i in (2, 3, 4):
        assert by[i] == [(i, 0, i, True)]
    assert by[None] == [(None, 4, None, False)]
    assert by[7] == [(7, 1, 7, True)]
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_one_id_with_several_texts_is_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, a), (5, b), (6, a), (7, b), (4, b + " c")], "doc_id long, text string")
    got = near_dup.near_duplicates(df, near_dup.NearDup(words=2)).collect()
    assert {r["component_id"] for r in got} == {4}
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [4]


def test_more_candidates_than_are_broadcast(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("headway.llm.components.BROADCAST_ROWS", 1)
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf_dir).collect()]
    check(near_dup.near_duplicates(documents(spark, sf_dir), near_dup.NearDup(words=2)), brute(rows, 2))


def test_no_key_is_told_away(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 5).selectExpr("id", "'x' AS may")
    keys = spark.range(0, 40_000, 7)
    asked = told(df.drop("may"), keys, ["id"], f"file://{tmp_path}/maps").collect()
    assert all(r["may"] for r in asked if r["id"] % 7 == 0)
    assert sum(r["may"] for r in asked) < 40_000 / 7 + 20
    assert told(df.drop("may"), keys.limit(0), ["id"], f"file://{tmp_path}/none").where("may").count() == 0


def test_an_id_links_what_stands_for_each_of_its_texts(spark):
    """5 stands for one of its texts, 3 for the other."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (7, b), (9, b + " c"), (11, "other words")], "doc_id long, text string")
    got = near_dup.near_duplicates(df, near_dup.NearDup(words=2)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {3: 3, 5: 3, 7: 3, 9: 3, 11: 11}


def test_union_find_in_rounds(spark, tmp_path, monkeypatch):
    """A long path, a star, and a self-link, in batches of a few links."""
    monkeypatch.setattr("headway.llm.components.BATCH_LINKS", 7)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(500, 500)]
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r["node"]: r["component"] for r in components(df, f"file://{tmp_path}/cc").collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {500: 500}
