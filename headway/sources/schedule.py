"""Schedule feeds: import from archives or folders, export, and Parquet storage by feed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import SCHEDULE, TableSpec
from ..config import validation_mode
from ..plans.validation import checked, feed_violations
from ..storage import drop_dir, shared_dir

FEED = "feed_id"


class FeedError(RuntimeError):
    """An import or export that failed, with its cause."""


@dataclass
class Feed:
    """Typed tables of a feed by name, the texts that they were read from, and further files by name."""

    tables: dict[str, DataFrame]
    raw: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def violations(self) -> DataFrame:
        """Everything that breaks a rule of a cell, a key or a reference: table, row_key, column, code, value."""
        return feed_violations(self.raw)

    def create_views(self, prefix: str = "") -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(f"{prefix}{name}")


def _path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, as Hadoop has them; any store that Spark reads will do."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _path(spark, path)
    return system.exists(target)


def _copy(spark: SparkSession, source: Any, sink: Any) -> None:
    """Bytes from one stream of the JVM to another, a buffer at a time."""
    spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, sink, 1 << 16, False)


def unpack(spark: SparkSession, path: str) -> str:
    """Unpack the archive's feed files to a new shared folder, whose address is returned. They are streamed, whatever their size; they must be of one folder."""
    staging, jvm = shared_dir(spark), spark.sparkContext._jvm
    known = {spec.source for spec in SCHEDULE.values()}
    folders: list[str] = []
    system, source = _path(spark, path)
    archive = jvm.java.util.zip.ZipInputStream(system.open(source))
    try:
        while (entry := archive.getNextEntry()) is not None:
            folder, _, name = entry.getName().rpartition("/")
            if name in known and not entry.isDirectory():
                if folder not in folders:
                    folders.append(folder)
                target_system, target = _path(spark, f"{staging}/{folders.index(folder)}/{name}")
                out = target_system.create(target, True)
                try:
                    _copy(spark, archive, out)
                finally:
                    out.close()
    finally:
        archive.close()
    if len(folders) != 1:
        raise FeedError(f"{path} holds no feed files" if not folders else f"{path} holds feed files in several folders: {', '.join(sorted(folders))}")
    return f"{staging}/0"


def read_raw(spark: SparkSession, file: str, spec: TableSpec, multiline: bool = False) -> DataFrame:
    """The declared columns of a file as text, by name; a column that the file lacks is NULL, others are left out.

    ``multiline`` allows line breaks within quotes; a file is then one task's.
    """
    read = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline).option("inferSchema", False)
    found = read.csv(file)
    names = {c.strip().lstrip("﻿").strip('"'): c for c in found.columns}
    return found.select(*((F.col(f"`{names[c.name]}`") if c.name in names else F.lit(None).cast("string")).alias(c.name) for c in spec.columns))


def import_schedule(spark: SparkSession, path: str, feed_id: str | None = None, mode: str | None = None, multiline: bool = False) -> Feed:
    """Read a feed from a zip archive or a folder: one table for each file that is there, every row with ``feed_id``.

    ``mode`` (off, flag, drop, fail) is what becomes of rows that break a rule; by default the session's setting. Files that the
    feed lacks are empty tables. Failures are FeedErrors with their cause.
    """
    mode = mode or validation_mode(spark)
    name = feed_id if feed_id is not None else path.rstrip("/").rpartition("/")[2].removesuffix(".zip")
    try:
        folder = unpack(spark, path) if path.endswith(".zip") else path
        raw, tables = {}, {}
        for key, spec in SCHEDULE.items():
            file = f"{folder.rstrip('/')}/{spec.source}"
            if _exists(spark, file):
                raw[key] = read_raw(spark, file, spec, multiline)
                tables[key] = checked(raw[key], spec, mode).withColumn(FEED, F.lit(name))
            else:
                tables[key] = spark.createDataFrame([], spec.schema()).withColumn(FEED, F.lit(name))
        if not raw:
            raise FeedError(f"{path} holds no feed files")
        return Feed(tables, raw)
    except FeedError:
        raise
    except Exception as e:
        raise FeedError(f"importing {path} failed: {e}") from e


def rendered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every declared column as the text that feeds have; NULL is empty."""
    return df.select(*(spec[c.name].kind.render(F.col(c.name)).alias(c.name) for c in spec.columns))


def export_schedule(tables: Mapping[str, DataFrame], path: str) -> str:
    """Write the tables as a feed: to a zip archive if ``path`` ends so, else to a folder. A file is written by one task, as feeds have one file a table.

    Tables without rows are left out. Within the archive, columns are in the catalog's order and rows in that of their partitions.
    """
    spark = next(iter(tables.values())).sparkSession
    staging, jvm = shared_dir(spark), spark.sparkContext._jvm
    written: dict[str, str] = {}
    for name, df in tables.items():
        spec = SCHEDULE[name]
        rows = rendered(df, spec)
        if rows.isEmpty():
            continue
        rows.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(f"{staging}/{name}")
        system, folder = _path(spark, f"{staging}/{name}")
        written[spec.source] = next(x.getPath().toString() for x in system.listStatus(folder) if x.getPath().getName().startswith("part-"))

    def send(part: str, sink: Any) -> None:
        system, source = _path(spark, part)
        stream = system.open(source)
        try:
            _copy(spark, stream, sink)
        finally:
            stream.close()

    if path.endswith(".zip"):
        system, target = _path(spark, path)
        archive = jvm.java.util.zip.ZipOutputStream(system.create(target, True))
        try:
            for name, part in sorted(written.items()):
                archive.putNextEntry(jvm.java.util.zip.ZipEntry(name))
                send(part, archive)
                archive.closeEntry()
        finally:
            archive.close()
    else:
        for name, part in written.items():
            system, target = _path(spark, f"{path.rstrip('/')}/{name}")
            out = system.create(target, True)
            try:
                send(part, out)
            finally:
                out.close()
    drop_dir(spark, staging)
    return path


def save(feed: Feed, folder: str) -> None:
    """Append the tables as Parquet, partitioned by feed, so that a query of one feed reads its files alone."""
    for name, df in feed.tables.items():
        df.write.mode("append").partitionBy(FEED).parquet(f"{folder.rstrip('/')}/{name}")


def load(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored tables, with the catalog's columns and ``feed_id``."""
    version = T.StructField(FEED, T.StringType())
    found = {name: f"{folder.rstrip('/')}/{name}" for name in SCHEDULE}
    return {name: spark.read.schema(SCHEDULE[name].schema().add(version)).parquet(path) for name, path in found.items() if _exists(spark, path)}
