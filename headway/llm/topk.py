"""Exact top-k by inner product, with a table of distances to pivots.

Each vector keeps its distances to many pivots. For a query q and a vector x, the largest difference between
their distances to one pivot is at most their own distance d, and as 2 q.x = |q|^2 + |x|^2 - d^2, that bounds
the score from above. Candidates are scored in the order of their bounds until the next bound is below the
k-th best score so far; what is left can't enter the result.

Components are whole numbers. Scores are sums of doubles as long as no product of two norms reaches 2**52, where
such sums are exact, and sums of Python's integers beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_tables, shared_dir, stored

SCALE = 1024
PIVOTS = 32
#: Rows from which pivots and the first thresholds are taken; a hash of vec_id chooses them.
SAMPLE = 2_000
#: Bytes of the queries that are broadcast at a time, and of the candidates that a task holds at a time (one of either at least).
QUERY_BYTES, CANDIDATE_BYTES = 16 << 20, 16 << 20
#: Queries that are broadcast at a time, and candidates that a task holds at a time, at most.
QUERY_BLOCK, CANDIDATE_BLOCK = 8_192, 16_384
#: Queries and candidates whose bounds are computed at once, and candidates that are scored before the first look at the threshold; twice as many before each further one.
BOUND_QUERIES, BOUND_CANDIDATES, STEP = 256, 2_048, 256
#: Products of norms below this have exact sums of doubles.
EXACT = 2.0**52
LONG = (-(1 << 63), (1 << 63) - 1)

_TABLE = "vec_id long, vector array<double>, distances array<float>"


def quantised(column: pa.ListArray) -> list[np.ndarray | None]:
    """floor(1024 x) of each vector; None for one that is null, or has a component that is null or not finite times 1024."""
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(flat * SCALE)
    ends, null = column.offsets.to_numpy(), column.is_null().to_pylist()
    parts = [flat[ends[i] : ends[i + 1]] for i in range(len(column))]
    return [None if null[i] or not np.isfinite(v).all() else v for i, v in enumerate(parts)]


def choose_pivots(sample: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each length of vectors, up to PIVOTS rows of the sample, each the farthest from those before it."""
    out = {}
    for dim, rows in sample.items():
        chosen, least = [0], ((rows - rows[0]) ** 2).sum(axis=1)
        while len(chosen) < min(PIVOTS, len(rows)) and least.max() > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        out[dim] = rows[chosen]
    return out


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row to each pivot, from the differences themselves, so that close vectors far from the origin keep their digits."""
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def rounded(x: np.ndarray) -> np.ndarray:
    """Distances as 32-bit numbers. Beyond their range they are cut, which makes no difference of two larger."""
    return np.minimum(x, np.finfo(np.float32).max).astype(np.float32)


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(axis=1))


def scores(rows: np.ndarray, query: np.ndarray, exact: bool) -> list[int] | np.ndarray:
    """Inner products: doubles that are whole numbers, or with ``exact`` Python's integers."""
    if not exact:
        return rows @ query
    q = [int(x) for x in query.tolist()]
    return [sum(int(a) * b for a, b in zip(row, q, strict=True)) for row in rows.tolist()]


class Best:
    """The k best (score, vec_id) of one query, higher scores first and smaller ids first among equals. ``floor``: scores below it can't be among the best."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor = k, floor
        self.scores: list[int] | np.ndarray = np.empty(0)
        self.ids = np.empty(0, np.int64)

    @property
    def threshold(self) -> float:
        return max(self.floor, self.scores[-1]) if len(self.scores) >= self.k else self.floor

    def add(self, scores: list[int] | np.ndarray, ids: np.ndarray) -> None:
        if isinstance(scores, np.ndarray) and isinstance(self.scores, np.ndarray):
            keep = scores >= self.threshold
            both, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
            order = np.lexsort((ids, -both))[: self.k]
            self.scores, self.ids = both[order], ids[order]
        else:  # integers beyond what doubles hold
            both = sorted((-int(s), i) for s, i in zip([*self.scores, *scores], [*self.ids.tolist(), *ids.tolist()], strict=True))[: self.k]
            self.scores, self.ids = [-s for s, _ in both], np.array([i for _, i in both], np.int64)


def bounds(queries: np.ndarray, near: np.ndarray, rows: np.ndarray, far: np.ndarray) -> np.ndarray:
    """A row for each query: what no candidate's score exceeds, from the largest difference of their distances to one pivot."""
    lower = np.zeros((len(near), len(far)), np.float32)
    for p in range(far.shape[1]):
        np.maximum(lower, np.abs(near[:, p, None] - far[None, :, p]), out=lower)
    slack = 1e-6 * (near.max(axis=1, initial=0)[:, None].astype(np.float64) + far.max(axis=1, initial=0)[None])  # distances are rounded to 32 bits
    lower = np.maximum(lower - slack, 0)
    whole = (queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1)[None]
    return (whole * (1 + 1e-12) - lower**2 * (1 - 1e-12)) / 2 + 1


def search_block(best: Best, query: np.ndarray, query_id: int, near: np.ndarray, ids: np.ndarray, rows: np.ndarray, far: np.ndarray, square: np.ndarray | None = None) -> int:
    """One query over some candidates; returns how many were scored."""
    return search_bounds(best, query, query_id, bounds(query[None], near[None], rows, far)[0], ids, rows)


def search_bounds(best: Best, query: np.ndarray, query_id: int, bound: np.ndarray, ids: np.ndarray, rows: np.ndarray, exact: bool = False) -> int:
    """Score candidates in bound order until none can enter; returns how many were scored."""
    mine = np.flatnonzero((bound >= best.threshold) & (ids != query_id))
    order = mine[np.argsort(-bound[mine], kind="stable")]
    at, step = 0, STEP
    while at < len(order) and bound[order[at]] >= best.threshold:
        part = order[at : at + step]
        best.add(scores(rows[part], query, exact), ids[part])
        at, step = at + len(part), 2 * step
    return at


class Block:
    """The vectors of one length among some rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, far: np.ndarray):
        self.ids, self.rows, self.far = ids, rows, far
        self.norm = float(norms(rows).max(initial=0))

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch) -> dict[int, Block]:
        """By length."""
        column = lambda c: table.column(c).combine_chunks() if isinstance(table, pa.Table) else table.column(c)
        if not table.num_rows:
            return {}
        vector, distance = (pa.concat_arrays([column(c)]) for c in ("vector", "distances"))  # from offset 0
        ids, ends, far_ends = column("vec_id").to_numpy(), vector.offsets.to_numpy(), distance.offsets.to_numpy()
        flat, far = vector.values.to_numpy(), distance.values.to_numpy()
        out, dims = {}, np.diff(ends)
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            wide = int(far_ends[own[0] + 1] - far_ends[own[0]])
            at = lambda starts, n, own=own: (starts[own][:, None] + np.arange(n)[None]).ravel()
            out[dim] = Block(ids[own], flat[at(ends, dim)].reshape(len(own), dim), far[at(far_ends, wide)].reshape(len(own), wide))
        return out


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches together, up to CANDIDATE_BLOCK rows or CANDIDATE_BYTES (or one batch)."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATE_BLOCK):
            piece = batch.slice(start, CANDIDATE_BLOCK)
            if held and (rows + piece.num_rows > CANDIDATE_BLOCK or size + piece.nbytes > CANDIDATE_BYTES):
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
            held.append(piece)
            rows, size = rows + piece.num_rows, size + piece.nbytes
    if held:
        yield pa.Table.from_batches(held)


def search(asking: dict[int, Block], found: dict[int, list[Best]], table: pa.Table) -> None:
    """All queries over some candidates."""
    for dim, block in Block.of(table).items():
        if dim not in asking:
            continue
        ask = asking[dim]
        exact = ask.norm * block.norm >= EXACT
        for first in range(0, len(ask.ids), BOUND_QUERIES):
            some = slice(first, first + BOUND_QUERIES)
            bound = np.concatenate([bounds(ask.rows[some], ask.far[some], block.rows[c : c + BOUND_CANDIDATES], block.far[c : c + BOUND_CANDIDATES]) for c in range(0, len(block.ids), BOUND_CANDIDATES)], axis=1)
            for i, above in enumerate(bound, first):
                search_bounds(found[dim][i], ask.rows[i], int(ask.ids[i]), above, block.ids, block.rows, exact)


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, folder: str | None = None) -> DataFrame:
    """The ``k`` best partners of each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    vectors: vec_id, embedding. Scores are inner products of floor(1024 x); equal scores go to the smaller
    vec_id. Vectors that are null, or have a component that is null or not finite (times 1024), and rows without vec_id take no part; vectors
    of different lengths aren't compared. Rows of the query's id are never its partners; other repeated rows
    count each. Of repeated query ids the smallest vector asks. No rows, or only one: no result. Scores rank
    by their exact value, whatever the components' size; one beyond the range of a long is given as the nearest long.

    The queries go over all rows in blocks of QUERY_BLOCK or QUERY_BYTES, which are broadcast one after the other; each task
    sends k rows a query at most. The pivot table is written to ``folder`` (by default a new one below
    ``spark.checkpoint.dir``), and so is each block's result.
    """
    spark = vectors.sparkSession
    folder = folder or shared_dir(spark)
    vectors = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    total = max(1, vectors.count())
    # The sample is a share of the hash space, cut to its bound.
    part = min(1.0, 1.5 * SAMPLE / total)
    picked = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(1 << 20)) < int(part * (1 << 20))).limit(SAMPLE).toArrow()
    sample: dict[int, list[np.ndarray]] = {}
    sample_ids: dict[int, list[int]] = {}
    column = pa.chunked_array(picked.column("embedding")).combine_chunks()
    for i, v in zip(picked.column("vec_id").to_pylist(), quantised(column) if len(picked) else [], strict=True):
        if v is not None:
            sample.setdefault(len(v), []).append(v)
            sample_ids.setdefault(len(v), []).append(i)
    known = {d: np.array(v).reshape(len(v), d) for d, v in sample.items()}
    pivots = choose_pivots(known)
    shared = spark.sparkContext.broadcast(pivots)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, v) for i, v in zip(batch.column("vec_id").to_pylist(), quantised(batch.column("embedding")), strict=True) if v is not None]
            far: list[np.ndarray] = [np.empty(0, np.float32)] * len(rows)
            for dim, centres in shared.value.items():
                own = [n for n, (_, v) in enumerate(rows) if len(v) == dim]
                if own:
                    for n, x in zip(own, rounded(distances(np.stack([rows[n][1] for n in own]), centres)), strict=True):
                        far[n] = x
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(pa.float64())), pa.array(far, pa.list_(pa.float32()))], ["vec_id", "vector", "distances"])

    data = stored(vectors.mapInArrow(index, _TABLE), f"{folder}/table")
    asking = data.where(F.pmod("vec_id", F.lit(every)) == 0)
    asking = stored(asking.groupBy("vec_id").agg(F.min(F.struct("vector", "distances")).alias("x")).select("vec_id", "x.*"), f"{folder}/queries")
    widest = asking.agg(F.count("*"), F.max(F.size("vector"))).first()
    block_rows = max(1, min(QUERY_BLOCK, QUERY_BYTES // (8 * (widest[1] or 0) + 4 * PIVOTS)))
    blocks = max(1, -(-widest[0] // block_rows))
    out = []
    for b in range(blocks):
        block = Block.of(asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow())
        floors: dict[int, list[float]] = {}
        for dim, ask in block.items():
            floors[dim] = []
            for i, q in zip(ask.ids.tolist(), ask.rows, strict=True):
                best = Best(k, -np.inf)
                if dim in known:
                    ids = np.array(sample_ids[dim])
                    near = known[dim]
                    exact = ask.norm * float(norms(near).max()) >= EXACT
                    best.add(scores(near[ids != i], q, exact), ids[ids != i])
                floors[dim].append(best.threshold)
        ask = spark.sparkContext.broadcast((block, floors))

        def run(batches: Iterator[pa.RecordBatch], ask=ask) -> Iterator[pa.RecordBatch]:
            asked, floors = ask.value
            found = {dim: [Best(k, floor) for floor in floors[dim]] for dim in asked}
            for table in gathered(batches):
                search(asked, found, table)
            for dim, block in asked.items():
                got = [(i, v, min(max(int(s), LONG[0]), LONG[1]), str(int(s))) for best, i in zip(found[dim], block.ids.tolist(), strict=True) for s, v in zip(best.scores, best.ids.tolist(), strict=True)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], kind) for c, kind in enumerate(kinds)], ["query_id", "vec_id", "score", "whole"])

        # Scores that were cut to a long rank by their digits: longer numbers first, then larger ones; below zero the other way round.
        whole = F.col("whole")
        sign = F.when(F.startswith(whole, F.lit("-")), -1).otherwise(1)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc(sign * F.length(whole)), F.when(sign > 0, whole).desc_nulls_last(), F.when(sign < 0, whole).asc_nulls_last(), "vec_id")
        ranked = data.mapInArrow(run, "query_id long, vec_id long, score long, whole string").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(f"{folder}/result/{b}")
        result = stored(ranked.select("query_id", "rank", "vec_id", "score"), out[-1])
    drop_tables(spark, folder, "table", "queries")
    return result if blocks == 1 else spark.read.schema(result.schema).parquet(*out) if blocks < 100 else spark.read.schema(result.schema).parquet(f"{folder}/result/*")
