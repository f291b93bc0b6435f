from __future__ import annotations

from collections import Counter

from headway.plans import queries


def rule(text: str | None) -> str | None:
    if not text:
        return None
    if len(text) > 255:
        return "max_length"
    return None if all(" " <= c <= "~" for c in text) else "invalid"


def check(spark, folder, texts):
    got = {r["doc_id"]: r["violation"] for r in queries.id_ascii(spark, folder).collect()}
    assert got == {k: rule(t) for k, t in texts.items()}
    return Counter(got.values())


def test_whole_texts_count(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check(spark, sf_dir, texts)["max_length"] > 0


def test_characters_beyond_the_fortieth_count(spark, tmp_path):
    texts = dict(enumerate(["a" * 40, "a" * 40 + "\u00e9", "a" * 254 + "\n", "a" * 255, "a" * 256, "\u00e9" * 256, "\u00e9", "", None]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert check(spark, str(tmp_path), texts) == {None: 4, "invalid": 3, "max_length": 2}
