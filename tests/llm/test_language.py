from __future__ import annotations

import os
import zlib

import numpy as np

from headway.llm import language, queries

from .frames import awkward, documents, empty


def larger(sf_dir: str) -> str:
    """The next larger tables, where they are there: held-out accuracy needs more rows."""
    found = sf_dir.replace("sf0.001", "sf0.01")
    return found if os.path.isdir(found) else sf_dir


def test_op6_held_out_accuracy(spark, sf_dir):
    sf_dir = larger(sf_dir)
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, sf_dir).collect()}
    rows = queries.op6_language(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["accepted"] for r in rows) >= 0.95 * len(rows)


def test_predictions_use_texts_alone(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.train(docs)
    a = language.identify(docs.select("doc_id", "text"), model)
    b = language.identify(docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source"), model)
    assert sorted(tuple(r["language"]) for r in a.collect()) == sorted(tuple(r["language"]) for r in b.collect())


def test_counts_are_those_of_a_loop():
    texts = ["Él, 1 niño!", "", "a", "ab cd"]
    got = language.counts(texts)
    for text, row in zip(texts, got, strict=True):
        raw = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in text.lower().encode())
        folded = b" " + raw + b" "
        while b"  " in folded:
            folded = folded.replace(b"  ", b" ")
        assert row.sum() == max(0, len(folded) - 2)
    assert np.array_equal(language.counts(["ab cd"])[0], language.counts(["AB-?cd"])[0])


def test_distance_rejects_what_is_like_no_language(spark, sf_dir):
    model = language.train(documents(spark, sf_dir))
    odd = spark.createDataFrame([(1, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία " * 20)], "doc_id long, text string")
    assert language.identify(odd, model).first()["language"]["accepted"] is False


def test_awkward_rows(spark):
    df = awkward(spark, "language", "score", "h", "n", "share", "a.b")
    model = language.train(df)
    rows = language.identify(df, model).collect()
    assert len(rows) == df.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert tuple(r["language"]) == ("und", 0.0, False)
        else:
            assert r["language"]["lang_pred"] in {"en", "de", "zh"}
        assert r["score"] == "clash"
    assert language.train(empty(spark)) is None
    assert {tuple(r["language"]) for r in language.identify(df, None).collect()} == {("und", 0.0, False)}
    assert language.identify(empty(spark), model).count() == 0


def test_op6_is_the_nearest_centroid_by_a_loop(spark, sf_dir):
    """Every prediction of the query, from counts and cosines made one text at a time."""
    docs = documents(spark, sf_dir)
    model = language.train(docs.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 <> 2"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in queries.op6_language(spark, sf_dir).collect():
        text = texts[r["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        raw = b" " + bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in text.lower().encode()) + b" "
        while b"  " in raw:
            raw = raw.replace(b"  ", b" ")
        tf = np.zeros(language.DIMENSIONS)
        for k in range(len(raw) - 2):
            gram = raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]
            tf[(gram * 2654435761 & 0xFFFFFFFF) >> 20] += 1
        x = np.log1p(tf) * model.idf
        cosines = [float(x @ c / np.linalg.norm(x)) for c in model.centroids.astype(float)]
        best = int(np.argmax(cosines))
        near = [language_ for c, language_ in zip(cosines, model.owner, strict=True) if c > cosines[best] - 1e-5]
        assert r["lang_pred"] in {model.languages[i] for i in near}
        assert abs(r["score"] - cosines[best]) < 1e-4
