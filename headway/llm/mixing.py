"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a fixed random order, form blocks of equal size. A source whose share of all weights is w
has its i-th block released at floor(i / w) and due at ceil((i + 1) / w). The released block of the earliest deadline
takes the next slot. As the shares sum up to 1, every deadline is met: after any number of slots, each source has
had its exact share to within less than one block. Shares are whole numbers of a common period D, large enough for
the weights to be exact; the schedule is a table of as many rows as there are slots, one for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from heapq import heappop, heappush
from itertools import accumulate, count, islice
from math import isfinite, lcm

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import shared_dir, stored

#: Documents in a block.
BLOCK_ROWS = 64
#: Sources at most; their counts are what the driver gets.
MOST_SOURCES = 1_000
#: Slots that a task holds at once while it writes the schedule.
BATCH_SLOTS = 65_536
#: A schedule of at most so many slots (of three numbers each) is broadcast.
BROADCAST_SLOTS = 500_000
#: The hash of a key: the first 60 bits of the MD5 of its text.
HASH = "cast(conv(substring(md5(cast(_key AS string)), 1, 15), 16, 10) AS long)"
#: Default weights go with a source's rows to this power.
TEMPERATURE = 0.7
#: Copies of one row that are made at once; a row that comes in more epochs is dealt out again before that.
EPOCHS = 1_000


def parts(weights: list[float], period: int | None = None) -> list[int]:
    """The weights as whole numbers in exactly their proportion. With a ``period``, whole parts of it, one at least each, that sum up to it: largest remainders."""
    if period is not None and len(weights) > period or any(not (w > 0 and isfinite(w)) for w in weights):
        raise ValueError("weights must be positive, finite, and not more than there are slots")
    if period is None:
        fractions = [Fraction(w) for w in weights]
        scale = lcm(*(f.denominator for f in fractions))
        return [int(f * scale) for f in fractions]
    total, free = sum(weights), period - len(weights)
    exact = [w / total * free for w in weights]
    out = [1 + int(x) for x in exact]
    rest = sorted(range(len(out)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in rest[: period - sum(out)]:
        out[i] += 1
    return out


def schedule(shares: list[int]) -> Iterator[tuple[int, int]]:
    """Of each slot of a period: the source that has it, and which of the source's blocks in the period it is."""
    period = sum(shares)
    due = lambda s, i: -(-(i + 1) * period // shares[s])
    waiting = [(0, s, 0) for s in range(len(shares))]
    ready: list[tuple[int, int, int]] = []
    waiting.sort()
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heappop(waiting)
            heappush(ready, (due(s, i), s, i))
        _, s, i = heappop(ready)
        yield s, i
        if i + 1 < shares[s]:
            heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))


def turns(shares: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """Source, turn of that source and slot, until every source has had as many turns as it has blocks."""
    left = sum(n > 0 for n in blocks)
    slot = 0
    for period in count():
        for s, i in schedule(shares):
            if not left:
                return
            turn = period * shares[s] + i
            yield s, turn, slot
            slot += 1
            left -= turn + 1 == blocks[s]


def _written(shares: list[int], blocks: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = turns(shares, blocks)
        while held := list(islice(rows, BATCH_SLOTS)):
            s, turn, slot = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(turn, pa.int64()), pa.array(slot, pa.int64())], ["_s", "_turn", "_slot"])

    return run


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", key: str = "doc_id", block_rows: int = BLOCK_ROWS, folder: str | None = None) -> DataFrame:
    """Append the struct ``mix``: block, epoch, slot and place (in the block). No row is dropped.

    The whole corpus goes in: the schedule ends as soon as every source has been used up once, and one
    that is used up earlier starts again (its rows come once per epoch). The last block of an epoch may be short
    of rows. Turns are therefore counted in rows: a source's turn t has the blocks that begin at the rows
    t * block_rows to (t + 1) * block_rows - 1 of its epochs one after the other, so a short block shares its turn
    with the next epoch's first. After any slot each source has its target weight to within less than one block in
    turns, and as many rows as its turns make, with less than one block more. Read the result in the order of
    (slot, epoch, place).

    ``weights`` has the target of every source that occurs (null is a source of its own); by default a
    source's rows to the power of TEMPERATURE. A source without a positive weight is an error. The order within
    a source follows a hash of ``key``, among equal or null keys one of the whole row. At most MOST_SOURCES sources: their
    counts are all that the driver gets; one task writes the schedule, a row for each slot. An empty table gives no rows. A column mix of the input is replaced.

    The rows are written once to ``folder``, sorted by source and hash in ranges of equal size, and ranks are their places there, so one source,
    one key or copies of one row may hold most rows.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    docs = docs.drop("mix")
    names = docs.columns
    packed = docs.select(F.col(source).alias("_source"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), F.col(key).alias("_key"))
    sizes = packed.groupBy("_source").count().orderBy("_source").limit(MOST_SOURCES + 1).collect()
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    kept_schema = docs.withColumn("mix", F.struct(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("int").alias("place"))).schema
    if not sizes:
        return spark.createDataFrame([], kept_schema)
    rows = {r[0]: r[1] for r in sizes}
    targets = {k: n**TEMPERATURE for k, n in rows.items()} if weights is None else {k: weights.get(k, 0) for k in rows}
    shares = parts(list(targets.values()))
    n_blocks = [-(-n // block_rows) for n in rows.values()]
    slots = stored(spark.range(0, 1, 1, 1).mapInArrow(_written(shares, n_blocks), "_s int, _turn long, _slot long"), f"{folder}/slots")
    had = {r[0]: r[1] for r in slots.groupBy("_s").agg(F.max("_turn") + 1).collect()}
    about = spark.createDataFrame([(i, k, had[i], n) for i, (k, n) in enumerate(zip(rows, rows.values(), strict=True))], "_s int, _name string, _turns long, _rows long")

    dealt = packed.join(F.broadcast(about.select("_s", "_name")), F.col("_source").eqNullSafe(F.col("_name"))).select("_s", "_row", F.expr(HASH).alias("_h"), F.xxhash64("_row").alias("_t"))
    begins = [0, *accumulate(rows.values())]
    ranked = numbered(dealt, "_s", "_h", "_t", name="_at", folder=folder).drop("_h", "_t")
    starts = spark.createDataFrame(list(enumerate(begins[:-1])), "_s int, _start long")
    placed = ranked.join(F.broadcast(about.drop("_name")), "_s").join(F.broadcast(starts), "_s").withColumn("_rank", F.col("_at") - F.col("_start")).withColumn("_block", F.expr(f"_rank div {block_rows}"))
    last = F.expr(f"((_turns - _block) * {block_rows} - 1) div _rows")
    if max((had[i] * block_rows) // n for i, n in enumerate(rows.values())) <= EPOCHS:
        epochs = placed.withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    else:
        some = placed.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(EPOCHS).cast("long")))).repartition("_s", "_rank", "_first")
        epochs = some.withColumn("_epoch", F.explode(F.sequence(F.col("_first"), F.least(last, F.col("_first") + EPOCHS - 1)))).drop("_first")
    turn = F.expr(f"_block + _epoch * _rows div {block_rows}")
    at = epochs.withColumn("_turn", turn).join(F.broadcast(slots) if sum(had.values()) <= BROADCAST_SLOTS else slots, ["_s", "_turn"])
    fields = F.struct(F.col("_block").alias("block"), F.col("_epoch").alias("epoch"), F.col("_slot").alias("slot"), F.expr(f"cast(_rank % {block_rows} as int)").alias("place"))
    return at.select(*(F.col("_row").getField(c).alias(c) for c in names), fields.alias("mix"))
