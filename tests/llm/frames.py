"""Small tables with everything that is awkward: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en", "a"),
    (2, "", "en", None),
    (3, None, None, "b"),
    (4, " \n\t ", "de", "b"),
    (None, "a text without an id", "en", "a"),
    (5, LONG, None, "a"),
    (6, "😀 é ß <|endoftext|> \x00 中文", "zh", "b"),
    (7, "x" * 200_000, "en", "b"),
    (8, "1 2 3 . , !", None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def awkward(spark: SparkSession, *clashing: str) -> DataFrame:
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in clashing:
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
