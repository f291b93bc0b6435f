from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway.llm import queries, warc
from tests.compare import same

PAGES = "page_id long, url string, html string"


def digest(html: str | None) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def keys(df):
    return df.select(warc.index_key(F.col("url"), F.col("page_id")).alias("key"))


def read(df, folder=None, **options):
    index, folder = warc.archive(df, folder, **options)
    return warc.lookup(keys(df), index).collect(), folder


def test_op7_agrees_with_sql(spark, sf_dir):
    same(queries.op7_warc(spark, sf_dir), queries.oracle_sql()["op7_warc"], sf_dir)


def test_every_payload_comes_back(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    rows, _ = read(pages)
    assert {r["page_id"]: r["payload"].decode() for r in rows if r["record_type"] == "response"} | {r["page_id"]: html[r["refers_to"]] for r in rows if r["record_type"] == "revisit"} == html


def test_archives_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.example.org/é x?q=1", "<p>é</p>"), (2, "http://b.example.org/", "<p>é</p>"), (3, None, None)], PAGES)
    _, folder = read(df, f"file://{tmp_path}/w")
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(f"{tmp_path}/w/archives").glob("*.warc.gz")))
    stream, types = io.BytesIO(whole), []
    while line := stream.readline():
        assert line == b"WARC/1.1\r\n"
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().strip().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        assert stream.read(4) == b"\r\n\r\n"
        types.append((headers["WARC-Type"], headers["WARC-Record-ID"], headers.get("WARC-Refers-To"), block.partition(b"\r\n\r\n")[2].decode()))
    assert sorted(types) == [("response", "<urn:page:1>", None, "<p>é</p>"), ("response", "<urn:page:3>", None, ""), ("revisit", "<urn:page:2>", "<urn:page:1>", "")]


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://a.Example.org/X?y=1#z", "org,example,a)/X?y=1"),
        ("https://user:pw@example.org:8080", "org,example:8080)"),
        ("//example.org/a\tb c", "org,example)/a%20b%20c"),
        ("no address", ")no%20address"),
        ("", ")"),
        (None, ")"),
    ],
)
def test_reversed_host_keys(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warc.surt(F.col("u"))).first()[0] == key


def test_lookups_find_all_and_nothing_else(spark, monkeypatch, tmp_path):
    """Small blocks, with equal keys that run over the ends of blocks and shards."""
    rows = [(i, f"http://h{i % 7}.example.org/p{i % 50}", f"page {i % 40}") for i in range(400)] + [(7, "http://h0.example.org/p7", "page 7")] * 30
    df = spark.createDataFrame(rows, PAGES)
    folder = f"file://{tmp_path}/w"
    cdx = warc.write_archives(df, folder)
    directory = warc.write_index(cdx, folder, block_lines=4)
    assert directory.count() >= 100
    index = warc.open_index(directory, folder)
    wanted = keys(df).unionByName(spark.createDataFrame([("org,example,h9)/ 1",), ("",), ("zz",)], "key string"))
    got = warc.lookup(wanted, index).collect()
    assert len(got) == len(rows)
    counts = defaultdict(int)
    for r in got:
        counts[r["page_id"]] += 1
        assert r["payload_digest"] == digest(f"page {r['page_id'] % 40}")
    assert counts[7] == 31
    assert len(counts) == 400


def test_many_repeated_payloads(spark, monkeypatch):
    """More than are broadcast: bitmaps tell which payloads may be repeated."""
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 5)
    rows = [(i, f"http://h{i % 7}.example.org/p{i}", f"page {i % 150}" if i < 300 else f"alone {i}") for i in range(600)] + [(None, "http://x.org/", "page 3"), (3, "http://x.org/", "page 3")]
    got, _ = read(spark.createDataFrame(rows, PAGES))
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            assert r["refers_to"] == (r["page_id"] - 150 if 150 <= r["page_id"] < 300 else None)
            assert (r["record_type"] == "revisit") == (r["refers_to"] is not None)
    assert [r["refers_to"] for r in got if r["page_id"] is None] == [3]


def test_record_ids_are_unique(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://x.org/", "a")] * 5 + [(None, "http://x.org/", "b")] * 4 + [(2, "http://x.org/", "c")], PAGES).repartition(3)
    got, _ = read(df, f"file://{tmp_path}/w")
    assert sorted((r["page_id"] or 0) for r in got) == [0] * 4 + [1] * 5 + [2]
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w/archives").glob("*.warc.gz"))
    ids = [line for line in whole.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    assert len(set(ids)) == len(ids) == 10
    assert b"WARC-Record-ID: <urn:page:2>" in ids


def test_least_bytes(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (5, "u", None), (6, "u", "")]
    df = spark.createDataFrame(rows, PAGES)
    plain = {r["page_id"]: r["refers_to"] for r in read(df)[0]}
    assert plain == {1: None, 2: 1, 3: None, 4: 3, 5: None, 6: 5}
    assert {r["page_id"]: r["refers_to"] for r in read(df, least_bytes=3)[0]} == {1: None, 2: None, 3: None, 4: 3, 5: None, 6: None}


def test_awkward_rows(spark):
    """Null ids, urls and pages, repeated rows, a long page, clashing columns."""
    rows = [(1, "http://x.org/", "a"), (1, "http://x.org/", "a"), (None, "http://x.org/", "a"), (None, None, "only"), (2, None, None), (3, "\x00\r\nX: y", "x" * 500_000), (4, "http://x.org/", "a")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'clash' AS key", "'clash' AS payload", "'clash' AS first", "'clash' AS sha")
    got, _ = read(df)
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got), key=str) == sorted(
        [(1, "response", None, 1), (1, "response", None, 1), (None, "revisit", 1, 1), (None, "response", None, 4), (2, "response", None, 0), (3, "response", None, 500_000), (4, "revisit", 1, 1)], key=str
    )
    assert read(spark.createDataFrame([], PAGES))[0] == []


def test_damage_is_told():
    member = warc.record(1, "http://x.org/", b"payload", None)
    assert warc.parse(member).payload == b"payload"
    bad = gzip.compress(gzip.decompress(member).replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(bad)
