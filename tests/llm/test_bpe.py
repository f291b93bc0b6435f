from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import bpe, queries, token_counts

from .frames import awkward, documents, empty

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
MODELS = {n: (Tokenizer.from_file(public_tokenizers.path(n)), bpe.Bpe(open(public_tokenizers.path(n), "rb").read())) for n in NAMES}
ALPHABET = [*"aàéÉßñΣσ İıK'sTLL're\t\n\r\x0b\x0c\x1c\x85   0123٣½Ⅷ_!?@#中文😀‍́\x00", "<|endoftext|>", "<|startoftext|>", "'ll", "the "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join))
@pytest.mark.parametrize("name", NAMES)
def test_ids_are_the_library_s(name, text):
    theirs, mine = MODELS[name]
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert mine.encode(text).tolist() == ids
    if name == "byte_bpe_50k.json":
        assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False) == text


def test_any_ids_decode_as_the_library_s():
    theirs, mine = MODELS["byte_bpe_50k.json"]
    r = random.Random(1)
    for _ in range(200):
        ids = [r.randrange(50_257) for _ in range(20)]
        assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_a_long_pretoken_takes_little_time():
    assert len(MODELS["byte_bpe_50k.json"][1].merge("ab" * 100_000)) == 100_000


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    model = MODELS["byte_bpe_50k.json"][1]
    cache = model.cache()
    text = "one two three four five six seven"
    assert model.encode(text, cache).tolist() == model.encode(text).tolist()
    assert len(cache) <= 3


def test_op1_over_whole_tables(spark, sf_dir):
    theirs = MODELS["byte_bpe_50k.json"][0]
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, sf_dir).collect()}
    rows = queries.op1_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op2_over_whole_tables(spark, sf_dir):
    theirs = MODELS["word_bpe_49k.json"][0]
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, sf_dir).collect()}
    for r in queries.op2_token_counts(spark, sf_dir).collect():
        text = texts[r["doc_id"]]
        n = len(theirs.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_awkward_rows(spark):
    """Repeated rows stay; null and empty texts have no ids; a clashing column is replaced, others stay."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = awkward(spark, "ids", "decoded", "key", "a.b")
    out = bpe.decode(bpe.encode(df, path), path)
    assert sorted(out.columns) == sorted(df.columns)
    rows = out.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r["decoded"] == (r["text"] or "")
        assert r["key"] == "clash"
        assert bool(r["ids"]) == bool(r["text"])
    together = bpe.encode(df, path, decoded="decoded")
    assert sorted(map(str, together.select(*(f"`{c}`" for c in out.columns)).collect())) == sorted(map(str, rows))
    counted = token_counts.count_tokens(awkward(spark, "n_tokens", "a.b"), public_tokenizers.path("word_bpe_49k.json")).collect()
    theirs = MODELS["word_bpe_49k.json"][0]
    assert all(r["n_tokens"] == len(theirs.encode(r["text"] or "", add_special_tokens=False).ids) for r in counted)
    assert bpe.encode(empty(spark), path).count() == token_counts.count_tokens(empty(spark), path).count() == 0


def test_a_null_array_decodes_to_null(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(None,), ([],), ([15496],)], "ids array<int>")
    assert [r[0] for r in bpe.decode(df, path).select("decoded").collect()] == [None, "", "Hello"]


def test_the_table_of_frequent_pretokens_changes_no_count(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    frequent = token_counts.frequent_pretokens(docs, path, most=50)
    assert len(frequent) == 50
    a = token_counts.count_tokens(docs, path, frequent=frequent)
    b = token_counts.count_tokens(docs, path, frequent=[])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_the_most_frequent_pretokens_are_found(spark):
    docs = spark.createDataFrame([("the cat the dog the cat",), ("the end",), (None,)], "text string")
    assert token_counts.frequent_pretokens(docs, public_tokenizers.path("word_bpe_49k.json"), most=2) == ["the", "cat"]


@pytest.mark.parametrize("name", NAMES)
def test_every_code_point(name):
    """Between letters, between digits, beside itself and before a contraction, a few hundred in a text, with spaces between."""
    theirs, mine = MODELS[name]
    cache = mine.cache()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b{c}{c} 1{c}2 {c}'s" for c in points[i : i + 256]) for i in range(0, len(points), 256)]
    for text, encoded in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.encode(text, cache).tolist() == encoded.ids


def test_the_packed_table_finds_all_and_nothing_else():
    model = MODELS["word_bpe_49k.json"][1]
    names = [f"w{i}é" for i in range(1000)] + ["", "the"]
    table = token_counts.Table(token_counts.pack(names, model))
    assert [table.get(n.encode()) for n in names] == [len(model.merge(n)) for n in names]
    assert [table.get(n) for n in (b"w1", b"thee", b"\x00")] == [None] * 3
    assert token_counts.Table(token_counts.pack([], model)).get(b"the") is None
