"""Longest common extensions inside sequences of symbols, by recompression.

Sequences stand one after another, an own symbol (a barrier) before the first and behind
each. The whole is compressed level by level into a run-length grammar: block steps replace a
maximal run of one symbol by a symbol for (symbol, length), pair steps split the alphabet in
two halves and replace every neighbouring (left, right) by a symbol for the pair. Equal
stretches are compressed alike but for their edges, so two places are compared by climbing
while an edge symbol is taken off at each level, and, from the first difference on, by
descending into the symbols that differ. Each query costs one step a level, all symbols
are compared exactly, and barriers equal nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Symbols left of the longest sequence when compression stops; what is left is compared one by one.
TOP = 4

_HALVES = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Level:
    """One level, and how its symbols were grouped into those of the next.

    ``up`` is the group of each symbol; ``first`` and ``count`` are the first member and the
    number of members of each group; ``second`` marks symbols that may be the later part of a
    pair and is None where the step was by blocks.
    """

    symbols: np.ndarray
    up: np.ndarray
    first: np.ndarray
    count: np.ndarray
    second: np.ndarray | None

    def mirrored(self, opposite: np.ndarray | None) -> Level:
        n, m = len(self.symbols), len(self.first)
        return Level(
            self.symbols[::-1],
            (m - 1 - self.up)[::-1],
            (n - self.first - self.count)[::-1],
            self.count[::-1],
            None if opposite is None else opposite[::-1],
        )


def _halves(symbols: np.ndarray, barriers: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Which symbols are left and which right parts: by a scrambled bit, turned to give more pairs."""
    x = (symbols.astype(np.uint64) + np.uint64(step * 2 + 1)) * _HALVES
    x ^= x >> np.uint64(29)
    bit = (x * _HALVES >> np.uint64(63)).astype(bool)
    inner = symbols >= barriers
    left, right = bit & inner, ~bit & inner
    if np.count_nonzero(right[:-1] & left[1:]) > np.count_nonzero(left[:-1] & right[1:]):
        left, right = right, left
    return left, right


class Grammar:
    """The levels over ``symbols``; those below ``barriers`` are barriers, each there once."""

    def __init__(self, symbols: np.ndarray, barriers: int, longest: int) -> None:
        symbols = symbols.astype(np.int64)
        self.levels: list[Level] = []
        self.mirror: list[Level] = []
        fresh = int(symbols.max(initial=0)) + 1
        step = 0
        while longest > TOP:
            symbols, fresh = self._blocks(symbols, fresh)
            symbols, fresh = self._pairs(symbols, fresh, barriers, step)
            step += 1
            edges = np.flatnonzero(symbols < barriers)
            longest = int(np.diff(edges).max(initial=1)) - 1
        self.top = symbols

    def _add(self, symbols: np.ndarray, starts: np.ndarray, second: np.ndarray | None, opposite: np.ndarray | None) -> np.ndarray:
        count = np.diff(starts, append=len(symbols))
        up = np.repeat(np.arange(len(starts)), count)
        level = Level(symbols, up, starts, count, second)
        self.levels.append(level)
        self.mirror.append(level.mirrored(opposite))
        return count

    def _blocks(self, symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
        if len(starts) == len(symbols):
            return symbols, fresh
        count = self._add(symbols, starts, None, None)
        out = symbols[starts]
        many = np.flatnonzero(count > 1)
        names, inverse = np.unique((out[many] << 32) | count[many], return_inverse=True)
        out[many] = fresh + inverse
        return out, fresh + len(names)

    def _pairs(self, symbols: np.ndarray, fresh: int, barriers: int, step: int) -> tuple[np.ndarray, int]:
        left, right = _halves(symbols, barriers, step)
        pair = np.flatnonzero(left[:-1] & right[1:])
        if not len(pair):
            return symbols, fresh
        keep = np.ones(len(symbols), dtype=bool)
        keep[pair + 1] = False
        starts = np.flatnonzero(keep)
        self._add(symbols, starts, right, left)
        out = symbols[starts]
        names, inverse = np.unique((symbols[pair] << 32) | symbols[pair + 1], return_inverse=True)
        # Places of the pairs among what is kept: each earlier pair took one symbol away.
        out[pair - np.arange(len(pair))] = fresh + inverse
        return out, fresh + len(names)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on are equal, for each pair of different places."""
        return _extend(self.levels, self.top, i, j) - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before ``i`` and before ``j`` are equal, for each pair of different places."""
        n = len(self.levels[0].symbols) if self.levels else len(self.top)
        a, b = n - i, n - j
        return _extend(self.mirror, self.top[::-1], a, b) - a


def _extend(levels: list[Level], top: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where, from the places ``a`` on, the first symbol differs from what goes on at ``b``."""
    alive = np.arange(len(a))
    stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for level in levels:
        same = level.symbols[a] == level.symbols[b]
        if level.second is None:
            rest_a = level.first[level.up[a]] + level.count[level.up[a]] - a
            rest_b = level.first[level.up[b]] + level.count[level.up[b]] - b
            taken = np.where(same, np.minimum(rest_a, rest_b), 0)
            same &= rest_a == rest_b
        else:
            taken = (same & level.second[a]).astype(np.int64)
        a, b = a + taken, b + taken
        halt = ~same
        stopped.append((alive[halt], a[halt], b[halt]))
        alive, a, b = alive[same], level.up[a[same]], level.up[b[same]]
    while True:
        same = top[a] == top[b]
        if not same.any():
            break
        a, b = a + same, b + same
    for level, (early, early_a, early_b) in zip(reversed(levels), reversed(stopped)):
        count_a, count_b = level.count[a], level.count[b]
        a, b = level.first[a], level.first[b]
        same = level.symbols[a] == level.symbols[b]
        taken = same * (np.minimum(count_a, count_b) if level.second is None else 1)
        alive = np.concatenate((alive, early))
        a, b = np.concatenate((a + taken, early_a)), np.concatenate((b + taken, early_b))
    out = np.empty(len(alive), dtype=np.int64)
    out[alive] = a
    return out
