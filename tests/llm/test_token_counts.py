from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest

from headway.llm import bpe, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_force(texts, most):
    model = bpe.Bpe(open(PATH, "rb").read())
    counts = Counter(tok for t in texts if t for _, toks in model.pieces(t) for tok in toks if len(tok) <= bpe.CACHED_CHARS)
    return [k for k, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:most]]


@pytest.mark.parametrize(("counted", "chars"), [(200_000, 16 << 20), (100, 16 << 20), (200_000, 1000)])
def test_frequent_pretokens_are_counted_over_all_rows(spark, monkeypatch, counted, chars):
    """More rows than a sample has, more different pre-tokens than a worker or a summary holds, and some too long for the table."""
    monkeypatch.setattr(token_counts, "COUNTED", counted)
    monkeypatch.setattr(token_counts, "COUNTED_CHARS", chars, raising=False)
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghéß", k=5)) for _ in range(4000)]
    texts = [" ".join(r.choices(words, weights=range(1, 4001), k=12)) for _ in range(6000)] + [None, "", "z" * 65 + " " + "y" * 64] * 200
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for most in (10, 3000, 5000):
        assert token_counts.frequent_pretokens(docs, PATH, most=most) == brute_force(texts, most)
