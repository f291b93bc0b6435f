from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import pii, queries

from .frames import awkward, documents, empty

# The base patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = ["a@b.c", "x.y+z@d-e.fr", "@", ".", "+1 (234) 555-1234", "+", "1.2.3.4", "256.1.1.1", "001.02.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "49", "-", " ", "é", "😀", "\n", "12", "call ", "(555) 123-4567", 'token = "abcdef0123456789abcdef"', "me (at) host.com", "ssn 123-45-6789", "a@b..c", "a@b.c+x@d.e", "1.2.3", "0" * 50 + "1.2.3.4", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"]


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            value = m.group()
            digits = re.sub("[^0-9]", "", value)
            if kind == "ip" and any(int(x) > 255 for x in value.split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def check(df):
    for r in pii.find(df).collect():
        base = [tuple(s) for s in r["pii_base"]]
        every = [tuple(s) for s in r["pii"]]
        assert base == brute(r["text"])
        assert set(base) <= set(every)
        assert every == sorted(every)
        more = [s for s in every if s not in base]
        for a in more:
            assert not any(a is not b and a[0] < b[2] and b[0] < a[2] for b in [*base, *more])


def test_spans_of_made_up_texts(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(600)]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_long_runs(spark):
    texts = ["1" * 3000, "a" * 3000 + "@bbb.c", "1.2." * 1500, " ".join(str(10**15 + i) for i in range(300))]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_very_long_runs_take_little_time(spark):
    """Such texts would take the plain patterns a time that grows with the square of their length."""
    texts = ["1" * 300_000, "a" * 300_000 + "@bbb.c", "1.2." * 5_000, "word12 " * 50_000]
    rows = pii.find(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [len(r["pii"]) for r in rows] == [0, 1, 2500, 0]
    assert tuple(rows[1]["pii"][0]) == (0, 0, 300_006, "email")


def test_op9(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}
    rows = queries.op9_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("you may call me at (555) 123-4567 today", ["phone"]),
        ("write to jane.doe (at) example.org please", ["email"]),
        ("his ssn 123-45-6789 was found", ["ssn"]),
        ('the token = "0123456789abcdef0123456789abcdef" leaked', ["secret"]),
        ("from host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 it came", ["ip"]),
        ("order 1234 567 890 was sent, item 12345", []),
        ("it sold 1200 times in 2019, version 1.2.3", []),
    ],
)
def test_the_trees_add_spans_by_format_and_context(spark, text, kinds):
    df = spark.createDataFrame([(text,)], "text string")
    assert [s["kind"] for s in pii.find(df).first()["pii"]] == kinds


def test_the_expression_scores_as_the_trees_do(spark):
    model = pii.train()
    x, _ = pii.examples(200, 7)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, x array<double>")
    got = [r[0] for r in df.orderBy("i").select(pii._score(model.trees, F.col("x"))).collect()]
    assert np.allclose(got, model.trees.margin(x))


def test_features_are_the_same_in_spark(spark):
    values = [("phone", "(555) 123-4567", "call me at ", " now"), ("card", "4111 1111 1111 1112", "card ", "x"), ("secret", "key = abcdefghijkl", "a", ""), ("ssn", "123-45-6789", "order ", "9")]
    for kind, value, left, right in values:
        df = spark.createDataFrame([(value, left, right)], "value string, left string, right string")
        got = df.select(F.array(*pii._features(kind, F.struct("value", "left", "right")))).first()[0]
        assert got == pii.features_of(kind, value, left, right)


def test_calibrated_precision():
    model = pii.train()
    x, y = pii.examples(4000, 99)
    margin = model.trees.margin(x)
    taken = np.array([m >= model.thresholds[pii.KINDS[int(k)]] for m, k in zip(margin, x[:, 0], strict=True)])
    assert y[taken].mean() >= 0.97
    assert taken[y == 1].mean() >= 0.7


def test_redaction(spark):
    text = "mail é a@b.c or +1 (234) 555-1234; 1.2.3.4 1.2.3.4, 4111 1111 1111 1111"
    out = pii.redact(spark.createDataFrame([(text, 1), (None, 2), ("", 3), ("clean", 4)], "text string, n int")).orderBy("n").collect()
    assert [r["text"] for r in out] == ["mail é [EMAIL] or [PHONE]; [IP] [IP], [CARD]", None, "", "clean"]


def test_overlapping_spans_are_redacted_once(spark):
    df = spark.createDataFrame([("abcdefgh", [(1, 0, 4, "ip"), (3, 1, 6, "card"), (6, 0, 7, "email")])], "t string, s array<struct<start:int,order:int,end:int,kind:string>>")
    assert df.select(pii.redacted(F.col("t"), F.col("s"))).first()[0] == "a[IP][EMAIL]h"


def test_awkward_rows(spark):
    df = awkward(spark, "pii", "pii_base", "_pii", "start", "a.b")
    rows = pii.find(df).collect()
    assert len(rows) == df.count()
    assert all(r["pii_base"] == [] and r["_pii"] == r["start"] == r["a.b"] == "clash" for r in rows)
    assert pii.find(empty(spark)).count() == 0
    again = pii.redact(df)
    assert again.columns == df.columns
    assert sorted(str(r["text"]) for r in again.collect()) == sorted(str(r["text"]) for r in df.collect())


def test_no_python_runs(spark, sf_dir):
    plan = queries.op9_pii(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
