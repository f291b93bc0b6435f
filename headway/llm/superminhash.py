"""SuperMinHash signatures of many sets at once.

Each element draws a permutation of the registers and a value in [0, 1) for each step; in step j it offers
``value + j`` to the register that its permutation has at place j. A register keeps the least offer. The
registers of one element thus get ranks from one permutation, which lowers the variance of the estimate.
A set is finished as soon as no later step can lower any of its registers, which for large sets is after
one or two of them.
"""

from __future__ import annotations

import numpy as np

from .textkit import U64, mix

#: A register is step << 32 | 32 random bits.
EMPTY = np.iinfo(np.uint64).max


def signatures(elements: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """One row of ``registers`` numbers for each set; ``bounds`` has where each set begins in ``elements``, and the end.

    Equal sets have equal rows, and two rows agree in a register with the sets' Jaccard similarity as
    probability. An empty set's row holds ``EMPTY``.
    """
    sets = len(bounds) - 1
    out = np.full(sets * registers, EMPTY, U64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(sets), sizes)
    elements = elements.astype(U64)
    places: np.ndarray | None = None
    with np.errstate(over="ignore"):
        for j in range(registers):
            drawn = mix(elements + U64(j + 1) * U64(0x9E3779B97F4A7C15))
            k = j + ((drawn & U64(0xFFFFFFFF)) * U64(registers - j) >> U64(32)).astype(np.int64)
            if places is None:
                place = k
            else:  # a step of the shuffle: what stands at k comes to place j
                rows = np.arange(len(elements))
                place = places[rows, k].astype(np.int64)
                places[rows, k] = places[rows, j]
            offer = U64(j) << U64(32) | drawn >> U64(32)
            np.minimum.at(out, owner * registers + place, offer)
            if not len(elements):
                break
            highest = out.reshape(sets, registers).max(axis=1)
            open_ = (highest >= U64(j + 1) << U64(32))[owner]
            if not open_.any():
                break
            if places is None:
                elements, owner, k = elements[open_], owner[open_], k[open_]
                places = np.tile(np.arange(registers, dtype=np.uint16), (len(elements), 1))
                rows = np.arange(len(elements))
                places[rows, k] = places[rows, 0]
            elif open_.mean() < 0.7:
                elements, owner, places = elements[open_], owner[open_], places[open_]
    return out.reshape(sets, registers)
