"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a broadcast hash table, of a bounded size, of the lengths, in tokens, of the corpus's frequent pre-tokens. What it
lacks is encoded on the spot; either answer is kept in the worker's own cache. The pre-tokens of the table are counted over all
rows, exactly. No pre-token is ever shuffled by occurrence: tasks count theirs, and only those counts are summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import CACHED_CHARS, Bpe, loaded
from .common import appended, chunks, mapped, read_small

#: Pre-tokens of the broadcast table; at 64 characters each it stays below 8 MB.
FREQUENT = 16_384
#: Different pre-tokens, and characters of text, that a worker counts at a time; beyond either it hands on all counts and starts anew.
COUNTED, COUNTED_CHARS = 200_000, 16 << 20
#: Entries of a worker's cache.
MISSES = 400_000


def frequent_pretokens(df: DataFrame, vocabulary: str, text: str = "text", most: int = FREQUENT) -> list[str]:
    """The corpus's frequent pre-tokens: the ``most`` highest counts over all rows and whole texts, of pre-tokens of ``CACHED_CHARS`` characters at most.

    Counts are exact. Each task hands on all that it counted, whenever its bound is reached and at its end; these
    are summed by pre-token (with a partial sum before the shuffle), and the ``most`` highest come to the driver, which gets no more
    rows however many tasks sum. Ties go to the smaller string. The list only decides what is looked up first, never a count of tokens.
    """
    data = df.sparkSession.sparkContext.broadcast(read_small(vocabulary))

    def handed_on(seen: Counter[str]) -> pa.RecordBatch:
        short = [(k, v) for k, v in seen.items() if len(k) <= CACHED_CHARS]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in short], pa.string()), pa.array([v for _, v in short], pa.int64())], ["pretoken", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = loaded(data.value)
        seen: Counter[str] = Counter()
        chars = 0
        for batch in chunks(batches, text, 4 << 20):
            for t in batch.column(text).to_pylist():
                if t:
                    seen.update(chain.from_iterable(toks for _, toks in model.pieces(t)))
                    chars += len(t)
                    if len(seen) > COUNTED or chars > COUNTED_CHARS:
                        yield handed_on(seen)
                        seen.clear()
                        chars = 0
        yield handed_on(seen)

    parts = df.select(text).mapInArrow(run, "pretoken string, n long")
    ranked = parts.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken")
    top = ranked.limit(most).repartition(1).collect()  # without it, the highest of every task would come to the driver
    return [k for k, _ in sorted(top, key=lambda r: (-r["n"], r["pretoken"]))]


class Table:
    """A hash table as four byte strings: slots by CRC-32 with linear probing, the pre-tokens' ends, the pre-tokens, and their lengths in tokens. Nothing is unpacked."""

    def __init__(self, packed: tuple[bytes, bytes, bytes, bytes]):
        self.slots, self.ends, self.lengths = (memoryview(packed[i]).cast(kind) for i, kind in ((0, "i"), (1, "I"), (3, "H")))
        self.text = packed[2]
        self.mask = len(self.slots) - 1

    def get(self, token: bytes) -> int | None:
        at = crc32(token) & self.mask
        while (i := self.slots[at]) >= 0:
            if self.text[self.ends[i] : self.ends[i + 1]] == token:
                return self.lengths[i]
            at = at + 1 & self.mask
        return None


def pack(frequent: list[str], model: Bpe) -> tuple[bytes, bytes, bytes, bytes]:
    """The :class:`Table` of some pre-tokens, at most half full."""
    tokens = [t.encode("utf-8", "surrogatepass") for t in dict.fromkeys(frequent)]
    size = 1 << (2 * len(tokens)).bit_length()
    slots = np.full(size, -1, np.int32)
    for i, token in enumerate(tokens):
        at = crc32(token) & size - 1
        while slots[at] >= 0:
            at = at + 1 & size - 1
        slots[at] = i
    ends = np.cumsum([0, *map(len, tokens)], dtype=np.uint32)
    lengths = np.array([len(model.merge(t)) for t in dict.fromkeys(frequent)], np.uint16)
    return slots.tobytes(), ends.tobytes(), b"".join(tokens), lengths.tobytes()


class Lengths(dict):
    """The worker's cache, up to a bound: pre-token -> number of tokens, from the table or encoded."""

    def __init__(self, model: Bpe, table: Table):
        super().__init__()
        self.model, self.table = model, table

    def __missing__(self, token: str) -> int:
        n = self.table.get(token.encode("utf-8", "surrogatepass"))
        if n is None:
            n = len(self.model.merge(token))
        if len(token) <= CACHED_CHARS:
            if len(self) >= MISSES:
                self.clear()
            self[token] = n
        return n


_tables: dict[tuple[int, int], Lengths] = {}


def _lengths(model: Bpe, vocabulary: bytes, packed: tuple[bytes, bytes, bytes, bytes]) -> Lengths:
    """The worker's cache for this vocabulary and this table."""
    key = hash(vocabulary), hash(packed)
    if key not in _tables:
        _tables.clear()
        _tables[key] = Lengths(model, Table(packed))
    return _tables[key]


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens", frequent: list[str] | None = None) -> DataFrame:
    """Append ``out`` (long), the number of tokens of each whole ``text``; null and empty texts have none.

    ``frequent`` is the table's content, by default :func:`frequent_pretokens` of the same rows. All rows
    and columns stay, but one named ``out``, which is replaced. One map over partitions, no shuffle (but that of the table's counts); the broadcast is bounded by ``FREQUENT``.
    """
    raw = read_small(vocabulary)
    spark = df.sparkSession.sparkContext
    packed = pack(frequent_pretokens(df, vocabulary, text) if frequent is None else frequent[:FREQUENT], Bpe(raw))
    data, shared = spark.broadcast(raw), spark.broadcast(packed)
    schema, names = appended(df, out, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = loaded(data.value)
        lengths = _lengths(model, data.value, shared.value)

        def count(t: str) -> int:
            return sum(sum(map(lengths.__getitem__, toks)) if special is None else 1 for special, toks in model.pieces(t))

        for batch in chunks(batches, text, 4 << 20):
            counts = pa.array([count(t) if t else 0 for t in batch.column(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), counts], [*names, out])

    return mapped(df, run, schema)
