"""Quality rules: boosted trees over document statistics, on top of two base rules.

Statistics are computed for whole texts, a batch of them at a time. The model is trained on a bounded
sample of labelled documents, held monotonic where more of a statistic can only speak against a text, and
broadcast as flat node arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, chunks, mapped
from .gbt import Trainer, Trees
from .textkit import U64, mix, repeated, words

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Labelled documents that the model is fitted to, at most; the order of a hash of doc_id chooses them.
TRAINING_ROWS = 20_000
#: Documents of each class that a model needs.
LEAST_CLASS = 10
#: Share of the good documents of that sample that the threshold keeps.
GOOD_KEPT = 0.999

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_bytes", "n_upper", "n_letters", "n_digits", "n_marks", "n_adjacent", "n_distinct")
#: Features, and the sign of their effect on the score where it is held monotonic (0: free).
FEATURES = {"symbols": -1, "dup_lines": -1, "repeats": -1, "upper": -1, "digits": 0, "marks": -1, "adjacent": -1, "distinct": 0, "word_length": 0, "words_a_line": 0, "log_words": 0}


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text; all are 0 for a null or empty one."""
    w = words(texts)
    n, owner = w.counts, w.owner
    table = np.zeros((6, 256), bool)
    table[0, list(SYMBOLS)] = True
    table[1, ord("A") : ord("Z") + 1] = True
    table[2] = table[1]
    table[2, ord("a") : ord("z") + 1] = True
    table[3, ord("0") : ord("9") + 1] = True
    table[4, [b for b in range(33, 127) if not chr(b).isalnum()]] = True
    table[5, 0x80:0xC0] = True  # bytes that continue a code point

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[w.bounds])

    symbols, upper, letters, digits, marks, inner = (per_text(t[w.data]) for t in table)
    word_bytes = np.bincount(owner, w.end - w.start, len(n)).astype(np.int64)

    # Lines run between line feeds and the texts' ends.
    feeds = np.flatnonzero(w.data == 0x0A)
    begin = np.sort(np.concatenate([w.bounds[:-1], feeds + 1]), kind="stable")
    finish = np.sort(np.concatenate([feeds, w.bounds[1:]]), kind="stable")
    of = np.searchsorted(w.bounds[1:], begin, side="right").clip(max=max(len(n) - 1, 0))
    has = np.searchsorted(w.start, finish) > np.searchsorted(w.start, begin)
    begin, finish, of = begin[has], finish[has], of[has]
    later = repeated(w.hashes(begin, finish), of)[1] if len(begin) else np.zeros(0, bool)

    # Windows of three words that a text has twice or more cover their words.
    h = w.hashes(w.start, w.end)
    covered = np.zeros(len(h), bool)
    adjacent = np.zeros(len(h), bool)
    if len(h) > 2:
        inside = owner[2:] == owner[:-2]
        with np.errstate(over="ignore"):
            window = mix(mix(h[:-2] * U64(3) + h[1:-1]) * U64(5) + h[2:])[inside]
        at = np.flatnonzero(inside)[repeated(window, owner[:-2][inside])[0]]
        for k in range(3):
            covered[at + k] = True
    if len(h) > 1:
        adjacent[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    count = lambda mask, who: np.bincount(who[mask], minlength=len(n)).astype(np.int64)
    every = np.ones(len(of), bool)
    return {
        "n_words": n.astype(np.int64),
        "word_chars": word_bytes - inner,
        "n_symbols": symbols,
        "n_dup_lines": count(later, of),
        "n_repeat_words": count(covered, owner),
        "n_lines": count(every, of),
        "n_bytes": np.diff(w.bounds),
        "n_upper": upper,
        "n_letters": letters,
        "n_digits": digits,
        "n_marks": marks,
        "n_adjacent": count(adjacent, owner),
        "n_distinct": count(~repeated(h, owner)[1], owner),
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios in the order of FEATURES."""
    per = lambda a, b: s[a] / np.maximum(s[b], 1)
    return np.stack([per("n_symbols", "n_words"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("n_upper", "n_letters"), per("n_digits", "n_words"), per("n_marks", "n_words"), per("n_adjacent", "n_words"), per("n_distinct", "n_words"), per("word_chars", "n_words"), per("n_words", "n_lines"), np.log1p(s["n_words"])], axis=1)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED_PERCENT * s["n_words"])


@dataclass
class Model:
    trees: Trees
    threshold: float


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit to at most ``TRAINING_ROWS`` labelled documents (labels: doc_id, quality 0 or 1; null labels are left out).

    A hash of doc_id orders the labels; the first of them are taken, whatever the order of rows, and at most as many rows of ``docs`` (repeated ids
    give a row each). Only documents of the sample are read into statistics. None if a class has fewer than ``LEAST_CLASS`` of them; the
    base rules decide alone then. Documents that they fail take no part. The threshold lets ``GOOD_KEPT``
    of the sample's good documents pass.
    """
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    # A share of the hash space that has more rows than needed, cut to the bound in hash order: the same rows however the tables are laid out.
    h = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)).alias("h")
    share = min(1.0, 1.2 * TRAINING_ROWS / max(1, known.count()) + 1e-3)
    chosen = known.select("*", h).where(F.col("h") < int(share * (1 << 20))).distinct().orderBy("h", "doc_id", "quality").limit(TRAINING_ROWS)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("h", "doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            s = statistics(batch.column("text"))
            passed = pa.array(~base_failed(s))
            x = pa.array(features(s).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).filter(passed) for c in ("h", "doc_id", "quality")), x.filter(passed)], ["h", "doc_id", "quality", "x"])

    # Ids may come more than once in docs, so the bound is held again here.
    rows = sample.mapInArrow(run, "h long, doc_id long, quality int, x array<double>").orderBy("h", "doc_id", "quality", "x").limit(TRAINING_ROWS)
    got = rows.select("quality", "x").toPandas()
    y = got["quality"].to_numpy(np.float64)
    if min((y == 1).sum(), (y == 0).sum()) < LEAST_CLASS:
        return None
    x = np.array(got["x"].tolist())
    order = np.lexsort((y, *x.T))  # whatever order the rows came in
    x, y = x[order], y[order]
    signs = {i: s for i, s in enumerate(FEATURES.values()) if s}
    trees = Trainer(monotonic=signs).fit(x, y)
    return Model(trees, min(0.5, float(np.quantile(trees.probability(x[y == 1]), 1 - GOOD_KEPT))))


VERDICT = T.StructType([*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def apply_rules(docs: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Append the struct ``quality_verdict``: the five counts, base_failed, score and kept, over whole texts.

    A null or empty text has no words and fails the base rules. Without a model the score is null and
    kept is not base_failed. All rows and other columns stay, a quality_verdict of the input is replaced; one map over partitions, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, names = appended(docs if keep_text else docs.drop(text), "quality_verdict", VERDICT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            s = statistics(batch.column(text))
            failed = base_failed(s)
            if shared.value is None:
                score, kept = pa.nulls(len(failed), pa.float64()), ~failed
            else:
                p = shared.value.trees.probability(features(s))
                score, kept = pa.array(p), ~failed & (p >= shared.value.threshold)
            columns = [*(pa.array(s[c], pa.int64()) for c in COUNTS), pa.array(failed), score, pa.array(kept)]
            verdict = pa.StructArray.from_arrays(columns, VERDICT.names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), verdict], [*names, "quality_verdict"])

    return mapped(docs, run, schema)
