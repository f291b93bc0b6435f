"""Language identification by the nearest of several centroids per language.

A text is the vector of its hashed byte trigrams, weighted by TF-IDF and of unit length. Each language's
sample is clustered into a few centroids by spherical k-means; a text gets the language of the centroid of
the highest cosine. One that is farther from it than nearly all of the language's own sample is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, chunks, mapped

DIMENSIONS = 4096
CENTROIDS = 4
#: Documents that the model is fitted to: a language's at most, and in all. A hash of doc_id chooses them.
LANGUAGE_ROWS, ROWS = 512, 4096
#: Share of a language's sample that is not rejected.
ACCEPTED = 0.995
UNDETERMINED = "und"
#: Texts whose vectors are held at a time.
HELD = 512

_LETTER = regex.compile(r"\p{L}")


def _folded() -> np.ndarray:
    """Letters of ASCII and bytes beyond it stay; all else becomes a space."""
    out = np.full(256, 0x20, np.uint8)
    out[0x80:] = np.arange(0x80, 0x100)
    out[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return out


_FOLDED = _folded()


def counts(texts: list[str]) -> np.ndarray:
    """Trigram counts of each whole text, in lower case, by hash; a run of other characters than letters is one space."""
    raw = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    data = _FOLDED[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(raw)), np.diff(bounds))
    space = data == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    data, owner = data[keep].astype(np.uint32), owner[keep]
    if len(data) < 3:
        return np.zeros((len(texts), DIMENSIONS), np.float32)
    gram = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    inside = owner[2:] == owner[:-2]
    slot = (gram[inside] * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    flat = np.bincount(owner[:-2][inside] * DIMENSIONS + slot, minlength=len(texts) * DIMENSIONS)
    return flat.reshape(len(texts), DIMENSIONS).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(tf) * idf)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    #: Index of each centroid's language, and the least cosine that each language accepts.
    owner: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each text's language index and cosine."""
        cosine = weighted(counts(texts), self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        return self.owner[best], np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(np.float64)


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from centroids that are far apart; the same rows give the same result."""
    chosen = [unit(x.mean(axis=0, keepdims=True))[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(x[int((x @ np.array(chosen).T).max(axis=1).argmin())])
    c = np.array(chosen)
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        c = np.array([unit(x[at == i].mean(axis=0, keepdims=True))[0] if (at == i).any() else c[i] for i in range(len(c))])
    return c


def train(docs: DataFrame, label: str = "lang") -> Model | None:
    """Fit to at most ``LANGUAGE_ROWS`` rows of each language and ``ROWS`` in all (8 of each language at least).

    docs: doc_id, text and ``label``. Rows without label, doc_id or a letter take no part. Languages are counted
    over all rows; a hash of doc_id then chooses each one's sample, whose vectors come to the driver. None
    without any such row.
    """
    usable = docs.select("doc_id", "text", F.col(label).alias("lang")).where("lang is not null and doc_id is not null and text rlike '\\\\p{L}'")
    sizes = {r[0]: r[1] for r in docs.where(F.col(label).isNotNull()).groupBy(label).count().limit(ROWS // 8 + 1).collect()}
    if len(sizes) > ROWS // 8:
        raise ValueError(f"more than {ROWS // 8} languages")
    if not sizes:
        return None
    most = max(8, min(LANGUAGE_ROWS, ROWS // len(sizes)))
    h = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 20))
    shares = docs.sparkSession.createDataFrame([(k, int(min(1.0, 4 * most / n + 1e-3) * (1 << 20))) for k, n in sorted(sizes.items())], "lang string, share long")
    near = usable.join(F.broadcast(shares), "lang").withColumn("h", h).where("h < share")
    chosen = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("n") <= most).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", rows=HELD):
            tf = counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in tf], pa.binary())], ["lang", "tf"])

    got = sorted(((r["lang"], bytes(r["tf"])) for r in chosen.mapInArrow(run, "lang string, tf binary").collect()))
    if not got:
        return None
    tf = np.frombuffer(b"".join(x for _, x in got), np.float32).reshape(len(got), DIMENSIONS)
    idf = (np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))) + 1).astype(np.float32)
    x, names = weighted(tf, idf), np.array([k for k, _ in got])
    languages = sorted(set(names.tolist()))
    centroids = [clustered(x[names == k], CENTROIDS) for k in languages]
    least = [float(np.quantile((x[names == k] @ c.T).max(axis=1), 1 - ACCEPTED)) for k, c in zip(languages, centroids, strict=True)]
    owner = np.concatenate([np.full(len(c), i) for i, c in enumerate(centroids)])
    return Model(languages, idf, np.concatenate(centroids).astype(np.float32), owner, np.array(least))


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Append the struct ``language``: lang_pred, score (the cosine, 0 to 1) and accepted, from whole texts alone.

    A text that is null, empty or without a letter is ``und`` with score 0 and not accepted; so is all without a
    model. All rows and other columns stay, a column language of the input is replaced; one map over partitions, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, names = appended(docs if keep_text else docs.drop(text), "language", PREDICTION)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in chunks(batches, text, rows=HELD):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            known = [m is not None and _LETTER.search(t) is not None for t in texts]
            if m is None:
                names_, score, accepted = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            else:
                at, score = m.predict(texts)
                names_ = [m.languages[i] if k else UNDETERMINED for i, k in zip(at, known, strict=True)]
                score = np.where(known, score, 0.0)
                accepted = np.array(known) & (score >= m.least[at])
            struct = pa.StructArray.from_arrays([pa.array(names_, pa.string()), pa.array(score), pa.array(accepted)], PREDICTION.names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), struct], [*names, "language"])

    return mapped(docs, run, schema)
