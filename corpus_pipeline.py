"""A training corpus from the documents table: five stages, each over all that the one before kept.

1. quality: documents that the quality rules reject go.
2. near_dedup: one document stays of each group of near-duplicates (shingles of five words, similarity 0.8 or more).
   Rows are documents, whether or not they have an id of their own.
3. pii: personal data in the texts is replaced by its kind.
4. mixing: sources come in their target weights, in the order of the schedule; sources used up early start again.
5. bpe: texts become token ids, and their decoded text's digest; position has the order of the schedule.

Every stage but the last returns the columns of documents, whatever further ones they have. Its result is written as Parquet below the shared folder
and read again, so a lost executor costs a part of one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, mixing, near_dup, pii, quality
from headway.llm.common import bounded, shared_dir, stored, table, told
from headway.llm.components import small
from headway.operators.order import in_file_order

#: Keys of rows without an id of their own begin here, so ids come first.
AFTER_IDS = 1 << 62
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Boosted trees, random signatures and the tokenizer are beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def _quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _aside(docs: DataFrame, name: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its own column ``name``, if any, under a free name, as an operator appends one so called; and what gives all columns back."""
    own = f"_{name}"
    while own in map(str.lower, docs.columns):
        own = f"_{own}"
    names = [own if c.lower() == name else c for c in docs.columns]
    return docs.toDF(*names), [at.alias(c) for at, c in zip(_quoted(names), docs.columns, strict=True)]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the model, fitted to these documents' labels, keep."""
    bounded(spark)
    docs, columns = _aside(docs, "quality_verdict")
    judged = quality.apply_rules(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return judged.where("quality_verdict.kept").select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest id.

    A row whose id is null or comes more than once is a document of its own, whose place among the others follows a hash of id and text and comes after all ids.
    Rows equal in both are one document, of which the first stays by a hash of the whole row.
    """
    bounded(spark)
    folder = shared_dir(spark)
    again = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), f"{folder}/again")
    n = again.count()
    if n == 0 and docs.where("doc_id is null").isEmpty():
        gone = near_dup.near_duplicates(docs, near_dup.NearDup(), f"{folder}/near").where("not kept").select("doc_id")
        gone = stored(gone.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")), f"{folder}/gone")
        asked = told(docs.select(F.struct(*_quoted(docs.columns)).alias("_row"), "doc_id"), gone, ["doc_id"], f"{folder}/told")  # most texts stay where they are
        return asked.where("not may").unionByName(asked.where("may").join(small(gone, gone.count()), "doc_id", "left_anti")).select("_row.*")
    packed = docs.select(F.struct(*_quoted(docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = packed.join(small(again.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("_again")), n), "doc_id", "left")
    odd = F.col("doc_id").isNull() | F.coalesce("_again", F.lit(False))
    beyond = F.lit(AFTER_IDS) + F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), F.lit(AFTER_IDS - 1))
    keyed = marked.select("_row", "text", odd.alias("_odd"), F.when(odd, beyond).otherwise(F.col("doc_id")).alias("_key"))
    kept = near_dup.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), near_dup.NearDup(), f"{folder}/near").where("kept").select(F.col("doc_id").alias("_key")).distinct()
    left = keyed.join(kept, "_key", "left_semi")
    firsts = left.where("_odd").groupBy("_key").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return left.where("not _odd").select("_row.*").unionByName(firsts.select("_row.*"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, redacted; ``n_chars`` is counted again."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in schedule order; those of sources that are used up early come again."""
    docs, columns = _aside(docs, "mix")
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange("mix.slot", "mix.epoch", "mix.place").sortWithinPartitions("mix.slot", "mix.epoch", "mix.place").select(*columns)


def _placed(docs: DataFrame) -> DataFrame:
    """With ``position``, the place of each row in the order in which the stage before wrote them; null if they come from no files."""
    try:
        return in_file_order(docs)
    except AnalysisException:
        return docs.withColumn("position", F.lit(None).cast("long"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """position (in the schedule of the mixing stage), doc_id, source, lang, ids, n_tokens and the SHA-256 of the text that the ids decode to."""
    bounded(spark)
    ids = bpe.encode(_placed(docs.select("doc_id", "source", "lang", "text")), VOCABULARY, keep_text=False, decoded="decoded")
    return ids.select("position", "doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("pii", pii_redaction), ("mixing", source_mixing), ("bpe", bpe_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; an empty table gives an empty result."""
    folder = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
