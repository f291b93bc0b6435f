"""All that a taken candidate covers is found and redacted, whatever else lies in it."""

from __future__ import annotations

import random
import re

import pytest

from headway.llm import pii

from .test_pii import brute

CARD = "4111111111111111"


def redacted(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    return [r["text"] for r in pii.redact(df).orderBy("n").collect()]


def test_a_secret_around_a_card_is_found_whole(spark):
    text = f'the token = "24be{CARD}c90fa1b2c3d4e5f60718" leaked'
    assert brute(text) == [(17, 2, 33, "card")]
    spans = pii.find(spark.createDataFrame([(text,)], "text string")).first()["pii"]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in spans] == [("secret", 'token = "24be'), ("card", CARD), ("secret", "c90fa1b2c3d4e5f60718")]
    assert redacted(spark, text) == ['the [SECRET][CARD][SECRET]" leaked']


def test_tokens_with_card_numbers_leave_nothing(spark):
    r = random.Random(11)
    run = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    texts = [f'so token = "{a}{CARD}{b}" is' for a, b in ((run(r.randint(0, 12)) + "a", "b" + run(r.randint(0, 12))) for _ in range(60))]
    assert all(re.fullmatch(r'so (\[(SECRET|CARD)\])+" is', t) for t in redacted(spark, *texts))


class Everything:
    """A model that takes every candidate."""

    trees = pii.train().trees
    thresholds = dict.fromkeys(pii.KINDS, float("-inf"))


@pytest.mark.parametrize("seed", range(1))
def test_every_taken_candidate_is_covered(spark, seed):
    """Chains of overlapping candidates too: the candidates come from the patterns, through Python's own."""
    r = random.Random(seed)
    texts = ["".join(r.choice(["555 123 4567", "(020) 555 1234 ", "12-34", " ", "4111 1111 1111 1111", ".", "123-45-6789", "1.2.3.4", "password=", "abcdef012345", "a@b.c", "x (at) y.org"]) for _ in range(8)) for _ in range(150)]
    rows = pii.find(spark.createDataFrame([(t,) for t in texts], "text string"), Everything()).collect()
    for row in rows:
        text, base, every = row["text"], [tuple(s) for s in row["pii_base"]], [tuple(s) for s in row["pii"]]
        assert set(base) <= set(every)
        covered = {i for s in every for i in range(s[0], s[2])}
        more = [s for s in every if s not in base]
        taken = [(m.start(), pii.KINDS.index(kind), m.end(), kind) for kind, pattern, _ in pii.GENERATORS for m in re.finditer(pattern, text)]
        assert covered == {i for s in [*base, *taken] for i in range(s[0], s[2])}
        assert not any(a is not b and a[0] < b[2] and b[0] < a[2] for a in more for b in every if a != b)
        kept = []
        for c in sorted(taken, key=lambda c: (c[0], -c[2], c[1])):
            if not kept or c[0] >= kept[-1][2]:
                kept.append(c)
        free = [c for c in kept if not any(c[0] < b[2] and b[0] < c[2] for b in base)]
        assert set(free) <= set(every)
