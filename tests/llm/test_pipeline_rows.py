"""Rows without ids of their own, and the order of the schedule."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from .frames import documents

WORDS = [f"word{i}" for i in range(80)]
A, B, C = " ".join(WORDS), " ".join(reversed(WORDS)), " ".join(w + "x" for w in WORDS)
NEAR = A + " more"


def kept(spark, sf_dir, rows):
    df = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    out = corpus_pipeline.near_dedup(spark, df, sf_dir)
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in out.collect()), key=str)


def test_rows_without_an_id_are_documents(spark, sf_dir):
    assert kept(spark, sf_dir, [(None, A, "a"), (None, B, "a"), (3, C, "a")]) == sorted([(None, A, "a"), (None, B, "a"), (3, C, "a")], key=str)
    assert kept(spark, sf_dir, [(None, A, "a"), (None, A, "a"), (7, NEAR, "a")]) == [(7, NEAR, "a")]
    assert len(kept(spark, sf_dir, [(None, A, "a"), (None, A, "b"), (None, None, "c")])) == 2


def test_texts_of_one_id_are_documents(spark, sf_dir):
    assert kept(spark, sf_dir, [(5, A, "a"), (5, B, "a"), (5, B, "a"), (9, C, "a")]) == sorted([(5, A, "a"), (5, B, "a"), (9, C, "a")], key=str)
    assert kept(spark, sf_dir, [(5, A, "a"), (5, B, "a"), (9, NEAR, "a")]) == sorted([(5, B, "a"), (9, NEAR, "a")], key=str)
    once = kept(spark, sf_dir, [(5, A, "a"), (5, A, "b"), (5, A, "b")])
    assert len(once) == 1


def test_the_result_has_the_order_of_the_schedule(spark, sf_dir, tmp_path):
    from headway.llm import mixing

    docs = documents(spark, sf_dir)
    corpus_pipeline.source_mixing(spark, docs, sf_dir).write.parquet(str(tmp_path / "mixed"))
    rows = corpus_pipeline.bpe_tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), sf_dir).select("position", "doc_id").collect()
    got = [r["doc_id"] for r in sorted(rows, key=lambda r: r["position"])]
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    mixed = mixing.mix(docs.select("doc_id", "source")).select("doc_id", "mix.*").collect()
    assert got == [r["doc_id"] for r in sorted(mixed, key=lambda r: (r["slot"], r["epoch"], r["place"]))]


def test_more_go_than_are_broadcast(spark, sf_dir, monkeypatch):
    docs = documents(spark, sf_dir)
    few = sorted(map(str, corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()))
    monkeypatch.setattr("headway.llm.components.BROADCAST_ROWS", 1)
    assert sorted(map(str, corpus_pipeline.near_dedup(spark, docs, sf_dir).collect())) == few


def test_further_columns_of_any_name_come_through(spark, sf_dir):
    """Also those that stages use for themselves; the last stage reads files whatever their names."""
    names = ("quality_verdict", "_quality_verdict", "MIX", "_row", "may", "pii", "_key", "_odd", "_s", "a.b", "position")
    docs = documents(spark, sf_dir)
    for name in names:
        docs = docs.withColumn(name, F.lit(f"my {name}"))
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    twice = docs.unionByName(docs.where("doc_id % 7 = 0"))  # ids that come twice go another way
    stages = (corpus_pipeline.quality_rules, docs), (corpus_pipeline.near_dedup, docs), (corpus_pipeline.near_dedup, twice), (corpus_pipeline.pii_redaction, docs), (corpus_pipeline.source_mixing, docs)
    for stage, given in stages:
        out = stage(spark, given, sf_dir)
        rows = out.collect()
        assert out.columns == docs.columns
        assert rows
        assert all(r[n] == f"my {n}" for r in rows for n in names)
    tokens = corpus_pipeline.bpe_tokens(spark, docs, sf_dir).select("doc_id", "position").collect()
    assert sorted(r["doc_id"] for r in tokens) == sorted(ids)
    assert sorted(r["position"] for r in tokens) == list(range(len(ids)))
