"""Many spans in one text take a time in proportion; marks in texts change nothing."""

from __future__ import annotations

import random
import time

from headway.llm import pii

from .test_pii import brute, check


def test_many_spans_in_one_text(spark):
    r = random.Random(9)
    piece = lambda: r.choice(["so mail a@b.c ", "so call (555) 123-4567 ", 'so token = "0123456789abcdef0123" ', "so 1.2.3.4 ", "so 4111 1111 1111 1111 ", "so ssn 123-45-6789 "])
    took = []
    for n in (1_000, 16_000):
        text = "".join(piece() for _ in range(n))
        df = spark.createDataFrame([(text,)], "text string")
        began = time.perf_counter()
        row = pii.find(df).first()
        clean = pii.redact(df).first()["text"]
        took.append(time.perf_counter() - began)
        assert [tuple(s) for s in row["pii_base"]] == brute(text)
        assert len(row["pii"]) == n
        assert clean.count("[") == n
    assert took[1] < took[0] + 20


def test_marks_in_texts(spark):
    texts = ["\x01a@b.c\x01", "a\x01@b.c", "1.2.3.4\x01\x021.2.3.4", "\x01", "\x01\x01 call (555) 123-4567\x01"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    check(df)
    clean = [r["text"] for r in pii.redact(df).collect()]
    assert clean == ["\x01[EMAIL]\x01", "a\x01@b.c", "[IP]\x01\x02[IP]", "\x01", "\x01\x01 call [PHONE]\x01"]
