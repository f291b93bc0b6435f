"""Small helpers that every operator of this subpackage shares."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import drop_dir, shared_dir, stored

__all__ = ["BATCHES", "CHUNK_BYTES", "appended", "bounded", "chunks", "drop_tables", "mapped", "read_small", "shared_dir", "stored", "table", "told"]

#: Bitmaps, and bits of each, that stand for a set of keys of any size; 16 MB in all.
BITMAPS, BITS = 4_096, 32_768

#: A chunk of texts that is processed at once by vectorised code, in bytes. It bounds a worker's memory.
CHUNK_BYTES = 1 << 18


#: Rows and bytes of the batches that go to Python workers, here as session settings.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def bounded(spark: SparkSession) -> None:
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_tables(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete intermediate tables that no result reads any more."""
    for name in names:
        drop_dir(spark, f"{folder}/{name}")


def told(df: DataFrame, keys: DataFrame, on: list[str], path: str, name: str = "may") -> DataFrame:
    """``df`` with a last column ``name``: may its values in ``on`` be among those of ``keys``? False is certain.

    A hash of the keys sets bits in bitmaps of a fixed size, written to ``path`` and broadcast however many keys there are, so that rows which a
    join would leave alone need no shuffle. The columns must have the same types on both sides; neither may have one named _bit, _map or _bits.
    """
    bit = F.pmod(F.xxhash64(*on), F.lit(BITMAPS * BITS)).alias("_bit")
    slim = keys.select(bit).select("_bit", F.expr(f"_bit div {BITS}").alias("_map")).repartition("_map")
    maps = stored(slim.groupBy("_map").agg(F.bitmap_construct_agg(F.col("_bit") % BITS).alias("_bits")), path)
    asked = df.select("*", bit).withColumn("_map", F.expr(f"_bit div {BITS}")).join(F.broadcast(maps), "_map", "left")
    byte = F.conv(F.hex(F.substring("_bits", F.expr(f"cast(_bit % {BITS} div 8 + 1 AS int)"), F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 AS int))")) != 0, F.lit(False))
    return asked.select(*(F.col(f"`{c}`") for c in df.columns), may.alias(name))


def appended(df: DataFrame, name: str, kind: T.DataType) -> tuple[T.StructType, list[str]]:
    """The schema of ``df`` with a last column ``name``, which takes the place of one of that name, and the names of the others."""
    fields = [f for f in df.schema.fields if f.name.lower() != name.lower()]
    return T.StructType([*fields, T.StructField(name, kind)]), [f.name for f in fields]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name, such as one with a dot, which PySpark would take for a field of a struct."""
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInArrow(lambda batches: run(b.rename_columns(names) for b in batches), schema)


def read_small(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file's bytes; refused beyond ``most``, as they are broadcast."""
    data = Path(path).read_bytes()
    if len(data) > most:
        raise ValueError(f"{path} has {len(data)} bytes; at most {most} are broadcast")
    return data


def chunks(batches: Iterable[pa.RecordBatch], column: str, most: int = CHUNK_BYTES, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that ``column`` has about ``most`` bytes, and ``rows`` values at most, in each piece (one at least)."""
    for batch in batches:
        texts = batch.column(column)
        lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lengths.tolist()):
            if i - start >= rows or total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)
