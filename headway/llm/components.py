"""Connected components of links, by union-find in bounded batches and contraction between rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Links that one union-find holds; it bounds a worker's memory.
BATCH_LINKS = 500_000
#: A side of at most so many rows (of a few numbers each) is broadcast; beyond that both sides are shuffled.
BROADCAST_ROWS = 10_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class UnionFind:
    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while (up := parent[x]) != root:
            parent[x], x = root, up
        return root

    def union(self, a: int, b: int) -> None:
        """The smaller root stays one."""
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(uf: UnionFind) -> pa.RecordBatch:
        nodes = list(uf.parent)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([uf.find(x) for x in nodes], pa.int64())], ["node", "root"])

    uf, held = UnionFind(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            uf.union(a, b)
        held += batch.num_rows
        if held >= BATCH_LINKS:
            yield flush(uf)
            uf, held = UnionFind(), 0
    if held:
        yield flush(uf)


def components(links: DataFrame, folder: str) -> DataFrame:
    """``links`` (a, b: long) to (node, component), where component is the smallest node that is reachable.

    Each round, every batch of links becomes a forest by union-find; a node takes the smallest of its roots,
    and what remains are links between roots. Rounds repeat on those, fewer each time, until none is left.
    The rounds' tables are written to ``folder``, so no lineage grows. A self-link names a node of its own.
    """
    levels: list[tuple[DataFrame, int]] = []
    rest = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    k = 0
    while True:
        forest = stored(rest.mapInArrow(_forest, "node long, root long"), f"{folder}/forest{k}")
        parents = stored(forest.groupBy("node").agg(F.min("root").alias("up")), f"{folder}/parents{k}")
        levels.append((parents, parents.count()))
        between = forest.join(small(parents, levels[-1][1]), "node").where("root <> up").select(F.col("root").alias("a"), F.col("up").alias("b")).distinct()
        rest = stored(between, f"{folder}/between{k}")
        left = rest.count()
        if not left:
            break
        rest = rest.coalesce(1 + left // BATCH_LINKS)
        k += 1
    labels = levels[-1][0].select("node", F.col("up").alias("component"))
    rows = levels[-1][1]
    for k, (parents, n) in reversed(list(enumerate(levels[:-1]))):
        above = labels.withColumnsRenamed({"node": "up"})
        labels = stored(parents.join(small(above, rows), "up", "left").select("node", F.coalesce("component", "up").alias("component")), f"{folder}/labels{k}")
        rows = n
    return labels


def block_matches(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted arrays without repeats share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
