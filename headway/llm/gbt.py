"""Gradient-boosted trees for two classes, trained with numpy on the driver over a bounded sample.

Features are binned at quantiles; trees grow level by level on histograms of first and second derivatives.
A feature may be held monotonic: a split that breaks the order is refused, and both sides stay on their side
of its middle from there on. A trained model is a few flat arrays of nodes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Flat nodes of all trees. A leaf points to itself and holds a value; the score is their sum as a probability."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Of each row: every tree is walked by all rows at once, a level at a time."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


@dataclass
class Trainer:
    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 64
    ridge: float = 2.0
    least_weight: float = 2.0
    #: feature -> 1 where the score may only rise with it, -1 where it may only fall
    monotonic: dict[int, int] = field(default_factory=dict)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        bias = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), bias)
        nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
        roots = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes["feature"]))
            margin += self._grow(binned, cuts, p - y, p * (1 - p), nodes)
        arrays = {k: np.array(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in nodes.items()}
        return Trees(np.array(roots), bias=bias, depth=self.depth, **arrays)

    def _grow(self, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, nodes: dict[str, list]) -> np.ndarray:
        added = np.zeros(len(g))

        def leaf(weight: float) -> int:
            n = len(nodes["feature"])
            for k, v in (("feature", 0), ("threshold", 0.0), ("left", n), ("right", n), ("value", weight * self.rate)):
                nodes[k].append(v)
            return n

        best_weight = lambda gs, hs, low, high: float(np.clip(-gs / (hs + self.ridge), low, high))
        todo = [(leaf(0.0), np.arange(len(g)), -np.inf, np.inf, 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            split = self._split(binned[:, rows], cuts, g[rows], h[rows], low, high) if level < self.depth else None
            if split is None:
                weight = best_weight(gs, hs, low, high)
                nodes["value"][node] = weight * self.rate
                added[rows] = weight * self.rate
                continue
            f, at, wl, wr = split
            goes = binned[f, rows] <= at
            middle, sign = (wl + wr) / 2, self.monotonic.get(f, 0)
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(sign, ((low, high), (low, high)))
            a, b = leaf(0.0), leaf(0.0)
            nodes["feature"][node], nodes["threshold"][node], nodes["left"][node], nodes["right"][node] = f, float(cuts[f][at]), a, b
            todo += [(a, rows[goes], *bounds[0], level + 1), (b, rows[~goes], *bounds[1], level + 1)]
        return added

    def _split(self, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, low: float, high: float) -> tuple[int, int, float, float] | None:
        best, found = 1e-3, None
        gain = lambda w, gs, hs: -(gs * w + 0.5 * (hs + self.ridge) * w * w)
        gs, hs = g.sum(), h.sum()
        base = gain(np.clip(-gs / (hs + self.ridge), low, high), gs, hs)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            gl = np.cumsum(np.bincount(binned[f], g, len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[f], h, len(c) + 1))[:-1]
            wl = np.clip(-gl / (hl + self.ridge), low, high)
            wr = np.clip(-(gs - gl) / (hs - hl + self.ridge), low, high)
            better = gain(wl, gl, hl) + gain(wr, gs - gl, hs - hl) - base
            better[(hl < self.least_weight) | (hs - hl < self.least_weight)] = -np.inf
            if sign := self.monotonic.get(f, 0):
                better[(wr - wl) * sign < 0] = -np.inf
            k = int(np.argmax(better))
            if better[k] > best:
                best, found = float(better[k]), (f, k, float(wl[k]), float(wr[k]))
        return found
