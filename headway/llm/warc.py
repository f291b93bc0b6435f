"""WARC archives, and a two-level index of what they hold.

Each partition writes its records, one gzip member each, to an archive of its own. A record whose payload equals
that of a smaller page is a revisit of it. The index has a line per record, sorted by the reversed-host
(SURT) form of the URL, in compressed blocks; a sparse directory has each block's first key. A lookup finds the
shard and the block by binary search, reads that one range, and then the record's own.

Files are written below a folder that driver and executors share, through pyarrow's file systems. A file's name holds
the attempt that wrote it and only a task that ended tells it on, so a lost executor leaves nothing but an unused file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, drop_tables, shared_dir, stored, told

#: Index lines of a block, and of a shard. With shards of this size the list of shards that is broadcast has a row for a million records.
BLOCK_LINES, SHARD_LINES = 512, 1_000_000
#: Bytes of records, and index lines, that a task of a lookup reads at most on average.
LOOKUP_BYTES, LOOKUP_LINES = 32 << 20, 50_000
#: Digests of repeated payloads, and ids of repeated rows, of which at most so many (of a few dozen bytes each) are broadcast.
BROADCAST_DIGESTS = 200_000
#: The shards that are broadcast at most; more need larger shards.
MOST_SHARDS = 100_000
#: Bytes after which a partition begins another archive.
ARCHIVE_BYTES = 1 << 30
#: Archives that a task keeps open.
OPEN_FILES = 64
#: The tables have no capture times.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CDX = "key string, page_id long, record_type string, digest string, file string, position long, length long"
_DIRECTORY = "shard string, first_key string, position long, length long, lines int"


def surt(url: Column) -> Column:
    """host labels reversed, the port if any, and path with query: ``http://a.example.org/x?y#z`` to ``org,example,a)/x?y``.

    The scheme, user and fragment go; white space and control characters are percent-encoded, so a key is one line. A null URL is ``)``.
    """
    url = F.coalesce(url, F.lit(""))
    start = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?"
    host = F.lower(F.regexp_extract(url, start + r"([^/?#:]*)", 1))
    port = F.regexp_extract(url, start + r"[^/?#:]*(:[0-9]+)", 1)
    rest = F.regexp_replace(F.regexp_replace(url, start + r"[^/?#]*", ""), "(?s)#.*$", "")
    return F.regexp_replace(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), port, F.lit(")"), rest), r"[\s\x00-\x1F]", "%20")


def index_key(url: Column, page_id: Column) -> Column:
    return F.concat(surt(url), F.lit(" "), F.coalesce(F.lpad(page_id.cast("string"), 20, "0"), F.lit("-")))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str = "") -> bytes:
    """One WARC/1.1 record as a gzip member: a response with the payload, or a revisit with the headers alone. With a ``place``, its id has that too."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}{':' * bool(place)}{place}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {target}"] if target else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def page_id(self) -> int | None:
        return _page(self.headers["WARC-Record-ID"])

    @property
    def refers_to(self) -> int | None:
        return _page(self.headers.get("WARC-Refers-To", "<urn:page:>"))


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">").partition(":")[0]
    return int(number) if number else None


def parse(member: bytes) -> Record:
    """Read one gzip member back; its lengths and digest must hold."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = lambda lines: dict(x.split(": ", 1) for x in lines[1:])
    headers = fields(head.decode().split("\r\n"))
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    out = Record(headers, fields(http.decode().split("\r\n")), payload)
    if headers["WARC-Type"] == "response" and (len(payload) != int(out.http["Content-Length"]) or headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}"):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return out


def _attempt() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.stageId()}-{task.taskAttemptId()}" if task else "000000"


def _create(folder: str, name: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


@lru_cache(maxsize=OPEN_FILES)
def _opened(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _range(uri: str, position: int, length: int) -> bytes:
    return _opened(uri).read_at(length, position)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return their index lines, stored.

    The payload is the HTML in UTF-8 (null: empty). Of records with equal payloads of ``least_bytes`` or more, those of the smallest page_id are
    responses and the others revisit it; shorter payloads are all responses. A row without page_id is a revisit where its payload has any
    page_id, else a response. Repeated rows are written each. The record of a row whose page_id is null or comes more than once has an id of its own, with its
    place in the archives; references name the page alone. No rows: no archives.

    Equal payloads are found by SHA-1 and length, of which those that come more than once are kept with their smallest id. They are broadcast, so that no
    payload is shuffled; if there are too many, only rows are shuffled whose digest may be one of them (bitmaps of a fixed size tell), and the others are written where they
    are. Digests are summed up before the shuffle, so a payload that a third of all pages share is no hot group, and AQE splits it in the join.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n"))
    firsts = slim.where(F.col("n") >= least_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1 and first is not null").drop("times")
    firsts = stored(firsts, f"{folder}/firsts")
    repeated = stored(slim.where("page_id is not null").groupBy("page_id").count().where("count > 1").select("page_id"), f"{folder}/repeated")
    n_repeated, n_firsts = repeated.count(), firsts.count()

    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n"))
    if n_repeated > BROADCAST_DIGESTS:  # then all records have ids with their places
        marked = hashed.withColumn("own", F.lit(True))
    else:
        named = hashed.join(F.broadcast(repeated.withColumn("again", F.lit(True))), "page_id", "left")
        marked = named.withColumn("own", F.col("page_id").isNull() | F.coalesce("again", F.lit(False))).drop("again")
    if n_firsts <= BROADCAST_DIGESTS:
        joined = marked.join(F.broadcast(firsts), ["sha", "n"], "left")
    else:
        asked = told(marked, firsts, ["sha", "n"], f"{folder}/maps")
        alone = asked.where("not may").withColumn("first", F.lit(None).cast("long"))
        joined = asked.where("may").join(firsts, ["sha", "n"], "left").unionByName(alone)
    other = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    rows = joined.select(index_key(F.col("url"), F.col("page_id")).alias("key"), "page_id", "url", "payload", "own", other.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, files = None, "", 0, 0
        try:
            for batch in chunks(batches, "payload", 4 << 20):
                lines = []
                for key, page_id, url, body, own, refers_to in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "url", "payload", "own", "refers_to")), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"{_attempt()}-{files:03d}.warc.gz"
                        out, at, files = _create(f"{folder}/archives", name), 0, files + 1
                    member = record(page_id, url, body, refers_to, f"{name}:{at}" if own else "")
                    out.write(member)
                    lines.append((key, page_id, "response" if refers_to is None else "revisit", digest(body), f"{folder}/archives/{name}", at, len(member)))
                    at += len(member)
                columns = list(zip(*lines, strict=True)) or [()] * 7
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "page_id", "record_type", "digest", "file", "position", "length"])
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInArrow(run, _CDX), f"{folder}/cdx")


def write_index(cdx: DataFrame, folder: str, block_lines: int = BLOCK_LINES, shard_lines: int = SHARD_LINES) -> DataFrame:
    """Sort index lines by key into compressed blocks, a file for each range of keys, and return the sparse directory, stored."""
    shards = 1 + cdx.count() // shard_lines
    spread = cdx.repartitionByRange(max(shards, 8), "key", "position").sortWithinPartitions("key", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, f"{_attempt()}.cdx", 0
        blocks: list[tuple[str, int, int, int]] = []
        held: list[dict] = []

        def flush() -> None:
            nonlocal out, at
            out = _create(f"{folder}/index", name) if out is None else out
            packed = zlib.compress("\n".join(r["key"] + "\t" + json.dumps([r["record_type"], r["digest"], r["file"], r["position"], r["length"]]) for r in held).encode())
            out.write(packed)
            blocks.append((held[0]["key"], at, len(packed), len(held)))
            at += len(packed)
            held.clear()

        try:
            for batch in batches:
                for row in batch.to_pylist():
                    held.append(row)
                    if len(held) >= block_lines:
                        flush()
            if held:
                flush()
        finally:
            if out is not None:
                out.close()
        columns = list(zip(*blocks, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/index/{name}"] * len(blocks), pa.string()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32())],
            ["shard", "first_key", "position", "length", "lines"],
        )

    return stored(spread.mapInArrow(run, _DIRECTORY), f"{folder}/directory")


@dataclass
class Index:
    """What a lookup needs on the driver: each shard's first key and where its directory is kept, and how much there is to read."""

    first_keys: list[str]
    shards: list[str]
    directories: list[str]
    lines: int = 0
    bytes: int = 0


def open_index(directory: DataFrame, folder: str, cdx: DataFrame | None = None) -> Index:
    """Write each shard's part of the directory beside it, and list the shards (one row for each, bounded by MOST_SHARDS)."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        ordered = sorted(zip(*(rows.column(c).to_pylist() for c in ("first_key", "position", "length")), strict=True), key=lambda r: r[1])
        name = f"{shard.rpartition('/')[2]}.{_attempt()}.dir"
        with _create(f"{folder}/index", name) as out:
            out.write(zlib.compress(json.dumps(ordered).encode()))
        return pa.table({"first_key": [ordered[0][0]], "shard": [shard], "directory": [f"{folder}/index/{name}"]})

    kept = stored(directory.groupBy("shard").applyInArrow(run, "first_key string, shard string, directory string"), f"{folder}/shards")
    rows = sorted(tuple(r) for r in kept.limit(MOST_SHARDS + 1).collect())
    if len(rows) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards; give more shard_lines")
    total = directory.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    size = cdx.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] if cdx is not None else 0
    return Index([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], total, size)


class Reader:
    """Lookups of one task. Sorted keys read each block once."""

    def __init__(self, index: Index):
        self.index = index
        self.shard = -1
        self.at: tuple[int, int] | None = None
        self.directory: list[list] = []
        self.firsts: list[str] = []
        self.keys: list[str] = []
        self.values: list[str] = []

    def _enter(self, shard: int) -> None:
        if self.shard != shard:
            system, path = fs.FileSystem.from_uri(self.index.directories[shard])
            with system.open_input_file(path) as f:
                self.directory = json.loads(zlib.decompress(f.read()))
            self.firsts = [d[0] for d in self.directory]
            self.shard = shard

    def _load(self, shard: int, block: int) -> None:
        if self.at != (shard, block):
            _, position, length = self.directory[block]
            lines = zlib.decompress(_range(self.index.shards[shard], position, length)).decode().split("\n")
            self.keys, self.values = map(list, zip(*(x.split("\t", 1) for x in lines), strict=True))
            self.at = shard, block

    def find(self, key: str) -> Iterator[list]:
        """All index lines of a key. Equal keys may run over a block's or a shard's end, so blocks are read from the last that begins below the key."""
        shard = max(0, bisect_right(self.index.first_keys, key) - 1)
        while shard > 0 and self.index.first_keys[shard] == key:
            shard -= 1
        while shard < len(self.index.shards) and self.index.first_keys[shard] <= key:
            self._enter(shard)
            firsts = self.firsts
            block = max(0, bisect_right(firsts, key) - 1)
            while block > 0 and firsts[block] == key:
                block -= 1
            while block < len(firsts) and firsts[block] <= key:
                self._load(shard, block)
                end = bisect_right(self.keys, key)
                while end > 0 and self.keys[end - 1] == key:
                    end -= 1
                    yield json.loads(self.values[end])
                block += 1
            shard += 1


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """Read the records of ``keys`` (one column, key) back from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Keys are read once each, in ranges, so a task goes through its part of the index in order. There are as many ranges as keep a task's records below
    LOOKUP_BYTES and its lines below LOOKUP_LINES on average. A key that the index lacks gives no row; a revisit's payload is null.
    """
    spark = keys.sparkSession
    shared = spark.sparkContext.broadcast(index)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, index.bytes // LOOKUP_BYTES + 1, index.lines // LOOKUP_LINES + 1)
    wanted = keys.distinct().repartitionByRange(ranges, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
            rows.clear()
            return out

        for batch in batches:
            for key in batch.column("key").to_pylist():
                for _, _, file, position, length in reader.find(key):
                    r = parse(_range(file, position, length))
                    whole = r.headers["WARC-Type"] == "response"
                    rows.append((r.page_id, int(r.http["Content-Length"]), r.headers["WARC-Payload-Digest"].removeprefix("sha1:"), r.headers["WARC-Type"], r.refers_to, r.payload if whole else None))
                    held += len(r.payload)
                    if held > 4 << 20 or len(rows) >= 1024:
                        yield flush()
                        held = 0
        yield flush()

    return wanted.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, shard_lines: int = SHARD_LINES) -> tuple[Index, str]:
    """Write archives and index of ``pages``; returns the index and the folder."""
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_dir(spark)
    cdx = write_archives(pages, folder, least_bytes)
    index = open_index(write_index(cdx, folder, shard_lines=shard_lines), folder, cdx)
    drop_tables(spark, folder, "firsts", "repeated", "maps", "cdx", "directory", "shards")
    return index, folder
