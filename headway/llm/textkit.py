"""Vectorised text statistics over Arrow string batches: words, lines and shingles as 64-bit hashes.

Words are runs of bytes other than space and U+0009 to U+000D. As those separators are single bytes in
UTF-8, all of this works on the bytes of a whole batch at once. A word's hash is a polynomial over a
random table of its bytes, modulo 2**64, with a final mix; it is the same in every batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(n, _BASE, U64)]))
        down = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(n, inverse, U64)]))
    return up, down


@lru_cache(maxsize=1)
def _separators() -> np.ndarray:
    sep = np.zeros(256, bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


@dataclass
class Words:
    """The words of a batch of texts. ``first`` has, for each text, the index of its first word; one more at the end."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    sums: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from each start to each end, the same wherever they stand."""
        down = _powers(_room(len(self.data)))[1]
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


def _room(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; a null text has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    if lower:
        data = lower_ascii(data)
    inside = ~_separators()[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | breaks[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    first = np.searchsorted(start, bounds)
    up = _powers(_room(len(data)))[0]
    with np.errstate(over="ignore"):
        sums = np.concatenate([[U64(0)], np.cumsum(_byte_table()[data] * up[: len(data)], dtype=U64)])
    return Words(data, bounds, start, end, first, sums)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles of ``size`` words as sorted hashes, one text after the other, and where each begins.

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    h = w.hashes(w.start, w.end)
    n, first = w.counts, w.first[:-1]
    made = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    begin = np.concatenate([[0], np.cumsum(made)])
    doc = np.repeat(np.arange(len(n)), made)
    at = np.repeat(first - begin[:-1], made) + np.arange(begin[-1])
    width = np.minimum(n, size)[doc]
    with np.errstate(over="ignore"):
        acc = width.astype(U64) * U64(0x8CB92BA72F3D8DD7)
        for k in range(size):
            has = k < width
            acc = np.where(has, mix(acc + h[np.where(has, at + k, 0)] * U64(2 * k + 1)), acc) if len(h) else acc
    order = np.lexsort((acc, doc))
    acc, doc = acc[order], doc[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (doc[1:] != doc[:-1])
    acc, doc = acc[new], doc[new]
    return acc, np.searchsorted(doc, np.arange(len(n) + 1))


def repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it found more than once with the same owner, and is it equal to an earlier one of it?"""
    many, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.lexsort((np.arange(len(keys)), keys, owner))
        k, o = keys[order], owner[order]
        same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
        later[order[1:]] = same
        many[order[1:]] |= same
        many[order[:-1]] |= same
    return many, later
