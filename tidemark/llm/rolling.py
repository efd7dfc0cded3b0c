"""Rolling 64-bit hashes of byte and word strings, vectorised.

A prefix sum of scrambled symbols times powers of an odd base gives the hash of any range
by one subtraction and one multiplication, all modulo 2^64; a final mix spreads the bits.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n; kept for the next call."""
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of 64-bit symbols, one longer than them."""
    up, _ = _power(len(symbols))
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * up[: len(symbols)], out=out[1:])
    return out


def byte_prefix(text: bytes) -> np.ndarray:
    return prefix(_BYTES[np.frombuffer(text, dtype=np.uint8)])


def ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the symbols from each start to before its end."""
    _, down = _power(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of that many symbols; empty if there are too few."""
    n = len(sums) - size
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    _, down = _power(len(sums))
    return mix((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII spaces and 0x09-0x0D."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.ones(len(raw) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def sliding_argmin(x: np.ndarray, size: int) -> np.ndarray:
    """Position of the least upper half in every window of that size, the leftmost of equals."""
    n = len(x) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    # Blocks of one window's size: each window is the end of one and the start of the next.
    blocks = -(-len(x) // size)
    keys = np.full(blocks * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    keys[: len(x)] = (x >> np.uint64(32) << np.uint64(32)) | np.arange(len(x), dtype=np.uint64)
    grid = keys.reshape(blocks, size)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:n], forward[size - 1 : size - 1 + n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
