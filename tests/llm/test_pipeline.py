from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from headway.llm import mixing, quality, queries

from .frames import documents, empty
from .test_near_dup import brute as brute_groups
from .test_pii import brute as brute_spans


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's result, written and read again."""
    out, docs = [documents(spark, sf_dir)], documents(spark, sf_dir)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "mixing", "bpe"]
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_quality(spark, sf_dir, stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    verdicts = {r["doc_id"]: r["kept"] for r in queries.op8_quality(spark, sf_dir).collect()}
    assert set(after) == {i for i, kept in verdicts.items() if kept}
    assert all(after[i] == before[i] for i in after)
    assert quality.LEAST_WORDS == 50


def test_near_dedup(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    groups = brute_groups([(i, r["text"]) for i, r in before.items()], 5)
    assert set(after) == {component for _, component in groups.values()}
    assert stages[2].count() == len(after)
    assert all(after[i] == before[i] for i in after)


def test_pii(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    assert set(before) == set(after)
    for i, r in after.items():
        assert brute_spans(r["text"]) == []
        assert r["n_chars"] == len(r["text"])
        if r["text"] != before[i]["text"]:
            assert any(f"[{k}]" in r["text"] for k in ("EMAIL", "IP", "CARD", "PHONE", "SSN", "SECRET"))
        else:
            assert brute_spans(before[i]["text"]) == []


def test_mixing(stages):
    before, after = by_id(stages[3]), stages[4].collect()
    assert {r["doc_id"] for r in after} == set(before)
    assert all(r == before[r["doc_id"]] for r in after)
    sizes = Counter(r["source"] for r in before.values())
    seen = Counter(r["source"] for r in after)
    total = sum(n**mixing.TEMPERATURE for n in sizes.values())
    blocks = {k: n / mixing.BLOCK_ROWS for k, n in seen.items()}
    assert all(blocks[k] <= sum(blocks.values()) * n**mixing.TEMPERATURE / total * 1.2 + 1 + len(sizes) for k, n in sizes.items())


def test_bpe(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = by_id(stages[4])
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r["ids"] == tokenizer.encode(texts[r["doc_id"]]["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])


def test_run_applies_all_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[-1].collect()))


def test_empty_documents_and_repeated_rows(spark, sf_dir):
    none = documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf_dir)
        if none.columns == documents(spark, sf_dir).columns:
            assert none.count() == 0
    assert none.count() == 0
    twice = documents(spark, sf_dir).unionByName(documents(spark, sf_dir))
    once = corpus_pipeline.near_dedup(spark, twice, sf_dir)
    assert once.count() == once.select("doc_id").distinct().count()
    assert empty(spark).count() == 0


def test_registered(spark):
    found = entry.queries()
    assert "pipeline" in found
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in found)
    assert {"op4_licenses", "op7_warc", "op10_topk"} <= set(entry.oracle_sql())
