"""Global order of rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import shared_dir, stored


def in_file_order(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows, from 0, of a Parquet table that was written in order, as Spark's writer names its files.

    A file's rows are numbered by the reader; the files' own row counts, one small row each, give where each begins. Files of
    other names come first, in the order of their paths.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    file = F.col("_metadata.file_path").alias("_file")
    part = F.regexp_extract("_file", "/part-([0-9]+)[^/]*$", 1).try_cast("int").alias("_part")
    counts = df.select(file).groupBy("_file").count()
    before = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("*", part).select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_begin"))
    placed = df.select(F.struct(*columns).alias("_row"), file, F.col("_metadata.row_index").alias("_index"))
    return placed.join(F.broadcast(begins), "_file").select("_row.*", (F.col("_begin") + F.col("_index")).alias(name))


def numbered(df: DataFrame, *order: str, name: str = "position", folder: str | None = None) -> DataFrame:
    """Number all rows, from 0, by the columns ``order`` (a leading ``-`` for descending; nulls first either way).

    Rows are dealt out by ranges of ``order`` and written, sorted, to ``folder`` (by default a new one in the shared folder), so the numbers hold from
    there on. Equal rows go by where they stand in the input, so that many of them make no large range.
    """
    folder = folder or shared_dir(df.sparkSession)
    keys = [F.col(f"`{c.removeprefix('-')}`") for c in order]
    by = [k.desc_nulls_first() if c.startswith("-") else k.asc_nulls_first() for k, c in zip(keys, order, strict=True)]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
    return in_file_order(stored(ranges, f"{folder}/numbered"), name)
