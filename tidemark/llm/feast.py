"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

The matrix is one of dimensions, not of rows, so it fits one process whatever the corpus.
Inertia counts (signs of the pivots of a symmetric factorisation) say how many eigenvalues
lie above a shift; with them the wanted part of the spectrum is cut into intervals of few
eigenvalues. For each interval a quadrature of complex shifted solves around it projects a block
of vectors onto its eigenspace, Rayleigh-Ritz extracts the pairs, and the step repeats until
they hold to rounding and are as many as inertia counted, so none is missed.
"""

from __future__ import annotations

import numpy as np

# Quadrature points on the upper half of a contour; eigenvalues that an interval should hold at most.
POINTS = 8
GROUP = 10
STEPS = 30


def negative_count(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are below 0, by Sylvester's law.

    Factorises with pivots of one or two rows, chosen from the whole rest so that the factors
    stay bounded.
    """
    a = a.copy()
    growth = (1 + 17**0.5) / 8
    count = 0
    while len(a):
        diagonal = int(np.argmax(np.abs(np.diag(a))))
        i, j = np.unravel_index(int(np.argmax(np.abs(a))), a.shape)
        most = abs(a[i, j])
        if most == 0:
            break
        if abs(a[diagonal, diagonal]) >= growth * most:
            take = [diagonal]
            count += int(a[diagonal, diagonal] < 0)
        else:
            # A pair whose off-diagonal outweighs: one eigenvalue on either side of 0.
            take = [int(i), int(j)]
            count += 1
        rest = np.delete(np.arange(len(a)), take)
        block = a[np.ix_(rest, take)]
        a = a[np.ix_(rest, rest)] - block @ np.linalg.solve(a[np.ix_(take, take)], block.T)
        a = (a + a.T) / 2
    return count


def count_above(v: np.ndarray, shift: float) -> int:
    return len(v) - negative_count(v - shift * np.eye(len(v)))


def _intervals(v: np.ndarray, wanted: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """Intervals that hold at least the ``wanted`` largest eigenvalues, with their counts."""
    narrow = 1e-9 * high
    # The lowest bound that leaves out as many others as bisection can tell.
    while high - low > narrow:
        middle = (low + high) / 2
        above = count_above(v, middle)
        if above >= wanted:
            low = middle
            if above == wanted:
                break
        else:
            high = middle
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    todo, done = [(low, count_above(v, low), top, 0)], []
    while todo:
        a, above_a, b, above_b = todo.pop()
        held = above_a - above_b
        if held <= GROUP or b - a <= narrow:
            if held:
                done.append((a, b, held))
            continue
        middle = (a + b) / 2
        above = count_above(v, middle)
        todo += [(a, above_a, middle, above), (middle, above, b, above_b)]
    return done


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(block)
    values, turn = np.linalg.eigh(q.T @ (v @ q))
    return values, q @ turn


def _project(v: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenspace of an interval, by quadrature over a circle around it."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for node, weight in zip(nodes, weights):
        turn = np.exp(-0.5j * np.pi * (node - 1))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, block.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def _pairs(v: np.ndarray, low: float, high: float, held: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``held`` eigenpairs between two shifts."""
    n = len(v)
    size = min(n, held + max(4, held // 2))
    precise = 1e-13 * float(np.abs(v).sum(axis=1).max())
    while True:
        block = rng.standard_normal((n, size)) if size < n else np.eye(n)
        for _ in range(STEPS if size < n else 1):
            block = _project(v, block, low, high) if size < n else block
            values, block = _ritz(v, block)
            inside = np.flatnonzero((values >= low) & (values <= high))
            off = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            if len(inside) == held and off.max(initial=0) <= precise:
                return values[inside], block[:, inside]
        if size == n:
            # Everything was solved at once; an eigenvalue on a bound may be counted on either side.
            nearest = np.argsort(np.maximum(low - values, values - high), kind="stable")[:held]
            return values[nearest], block[:, nearest]
        size = min(n, 2 * size)


def largest_eigenpairs(v: np.ndarray, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues, falling, and unit vectors as columns.

    Eigenvalues that rounding cannot tell from 0 are left out. Each vector's largest entry is positive.
    """
    n = len(v)
    top = float(np.abs(v).sum(axis=1).max(initial=0))
    zero = 8 * max(1, n) * np.finfo(float).eps * top
    if not top:
        return np.empty(0), np.empty((n, 0))
    # Solves are stable whatever the scale; a matrix of norm 1 keeps tolerances plain.
    scaled = v / top
    wanted = min(wanted, count_above(scaled, zero / top))
    if not wanted:
        return np.empty(0), np.empty((n, 0))
    rng = np.random.default_rng(seed)
    parts = [_pairs(scaled, a, b, held, rng) for a, b, held in _intervals(scaled, wanted, zero / top, 1.0 + 1e-9)]
    values, vectors = _ritz(scaled, np.concatenate([x for _, x in parts], axis=1))
    if len(values) < wanted:
        raise ArithmeticError(f"{len(values)} eigenpairs found of {wanted} counted")
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))])
    return values[order] * top, vectors * signs
