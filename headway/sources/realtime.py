"""Realtime messages: read from files or fetched, and decoded to nested structs."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from . import wire

TIMEOUT = 10.0
PAYLOADS = "url string, payload binary"


def fetch(url: str, timeout: float = TIMEOUT, headers: Mapping[str, str] | None = None) -> bytes:
    """GET; a status that tells an error raises, and so does a time-out."""
    with urllib.request.urlopen(urllib.request.Request(url, headers=dict(headers or {})), timeout=timeout) as got:
        return got.read()


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.urls = [u for u in options.get("url", options.get("path", "")).split() if u]
        if not self.urls:
            raise ValueError("option url is needed: one or more addresses, separated by white space")
        self.timeout = float(options.get("timeout", TIMEOUT))
        self.headers = json.loads(options.get("headers", "{}"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield partition.value, fetch(partition.value, self.timeout, self.headers)


class _Snapshots(SimpleDataSourceStreamReader):
    """Each trigger fetches every address once, as one snapshot.

    With the option ``snapshots``, a folder that outlives the driver, a snapshot is written there before Spark is told of it, so a batch that is
    run again, by a restarted driver too, is the same. Without it snapshots are kept in memory; a batch that was planned before a
    restart then fails, rather than being lost in silence. A committed snapshot is deleted.
    """

    def __init__(self, options: Mapping[str, str]):
        self.reader = _Reader(options)
        self.folder = options.get("snapshots")
        self.kept: dict[int, list[tuple]] = {}

    def initialOffset(self) -> dict:
        return {"snapshot": 0}

    def _file(self, n: int) -> tuple[fs.FileSystem, str]:
        system, base = fs.FileSystem.from_uri(self.folder)
        return system, f"{base.rstrip('/')}/{n}.arrow"

    def _write(self, n: int, rows: list[tuple]) -> None:
        system, path = self._file(n)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        table = pa.table({"url": pa.array([u for u, _ in rows], pa.string()), "payload": pa.array([p for _, p in rows], pa.binary())})
        with system.open_output_stream(f"{path}.part") as sink, pa.ipc.new_file(sink, table.schema) as out:
            out.write_table(table)
        system.move(f"{path}.part", path)

    def _rows(self, n: int) -> list[tuple]:
        if n in self.kept:
            return self.kept[n]
        if self.folder:
            system, path = self._file(n)
            with system.open_input_file(path) as source, pa.ipc.open_file(source) as found:
                table = found.read_all()
            return list(zip(table.column("url").to_pylist(), table.column("payload").to_pylist(), strict=True))
        raise RuntimeError(f"snapshot {n} was kept in memory by a driver that is gone; give the option snapshots")

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        n = start["snapshot"]
        rows = [(u, fetch(u, self.reader.timeout, self.reader.headers)) for u in self.reader.urls]
        if self.folder:
            self._write(n, rows)
        self.kept[n] = rows
        return iter(rows), {"snapshot": n + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([r for n in range(start["snapshot"], end["snapshot"]) for r in self._rows(n)])

    def commit(self, end: dict) -> None:
        self.kept = {n: r for n, r in self.kept.items() if n >= end["snapshot"]}
        if self.folder:
            system, path = self._file(0)
            for x in system.get_file_info(fs.FileSelector(path.rpartition("/")[0], allow_not_found=True)):
                name = x.base_name.removesuffix(".arrow")
                if name.isdigit() and int(name) < end["snapshot"]:
                    system.delete_file(x.path)


class RealtimeSource(DataSource):
    """``spark.read.format("transit_realtime").option("url", ...)``: url and payload of each address, one task for each.

    Options: url (white space between several), timeout in seconds, headers as a JSON object; of streams, snapshots, a folder where what was fetched is kept until it is committed.
    """

    @classmethod
    def name(cls) -> str:
        return "transit_realtime"

    def schema(self) -> str:
        return PAYLOADS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Snapshots(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RealtimeSource)


def decode_messages(payloads: DataFrame, payload: str = "payload", on_error: str = "fail") -> DataFrame:
    """Append feed_message_id (of the payload's SHA-256), ``message`` and ``error`` in place of ``payload``.

    A damaged payload fails the query, or with ``on_error="keep"`` has a NULL message and the reason. A NULL payload is a NULL message.
    """
    kind = _parse_datatype_string(wire.ddl())
    names = [c for c in payloads.columns if c != payload]
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            messages, errors = [], []
            for data in batch.column(payload).to_pylist():
                try:
                    messages.append(None if data is None else wire.row(wire.decode(data)))
                    errors.append(None)
                except wire.DecodeError as e:
                    if on_error == "fail":
                        raise
                    messages.append(None)
                    errors.append(str(e))
            columns = [*(batch.column(c) for c in names), batch.column("feed_message_id"), pa.array(messages, arrow), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "feed_message_id", "message", "error"])

    keyed = payloads.select(*names, F.col(payload), F.substring(F.sha2(payload, 256), 1, 32).alias("feed_message_id"))
    schema = StructType([*(keyed.schema[c] for c in [*names, "feed_message_id"])]).add("message", kind).add("error", "string")
    return keyed.mapInArrow(run, schema)


def import_realtime(spark: SparkSession, url: str, timeout: float = TIMEOUT, headers: Mapping[str, str] | None = None) -> DataFrame:
    """Fetch and decode the messages at one or more addresses (white space between them)."""
    register(spark)
    read = spark.read.format("transit_realtime").option("url", url).option("timeout", str(timeout)).option("headers", json.dumps(dict(headers or {})))
    return decode_messages(read.load())


class RealtimeClient:
    """Messages below one base address, with a time-out and headers for every request."""

    def __init__(self, base_url: str, timeout: float = TIMEOUT, headers: Mapping[str, str] | None = None):
        self.base_url, self.timeout, self.headers = base_url, timeout, headers

    def messages(self, spark: SparkSession, *paths: str) -> DataFrame:
        """Fetch and decode each path below the base address, or the base address itself."""
        base = self.base_url.rstrip("/")
        urls = [f"{base}/{p.lstrip('/')}" for p in paths] or [self.base_url]
        return import_realtime(spark, " ".join(urls), self.timeout, self.headers)


def read_messages(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Decode message files, one message in each."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), F.col("content").alias("payload"))
    return decode_messages(files, on_error=on_error)
