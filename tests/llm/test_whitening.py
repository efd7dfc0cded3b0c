"""Whitening against a dense decomposition, and the eigenpairs behind it."""

import numpy as np
import pytest
from conftest import SF

from tidemark.llm.feast import count_above, largest_eigenpairs, negative_count
from tidemark.llm.queries import QUERIES
from tidemark.llm.whitening import whiten


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((5 + 4 * seed, 5 + 4 * seed)) * (rng.random((5 + 4 * seed, 5 + 4 * seed)) < 0.5)
    a = a + a.T + 1e-3 * np.eye(len(a))
    assert negative_count(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert count_above(a, 0.3) == (np.linalg.eigvalsh(a) > 0.3).sum()


@pytest.mark.parametrize("case", ["plain", "graded", "repeated", "equal", "low rank", "one"])
def test_eigenpairs_equal_a_dense_solver(case):
    rng = np.random.default_rng(3)
    n = 1 if case == "one" else 50
    x = rng.standard_normal((300, n))
    if case == "graded":
        x *= 10.0 ** np.linspace(-3, 3, n)
    if case == "low rank":
        x[:, 10:] = x[:, :10].repeat(4, axis=1)
    v = x.T @ x / 300
    if case == "repeated":
        v = np.kron(np.diag(np.arange(1.0, 6)), np.eye(10))
    if case == "equal":
        v = 3.0 * np.eye(n)
    values, vectors = largest_eigenpairs(v, 32)
    want = np.linalg.eigvalsh(v)[::-1]
    assert len(values) == {"one": 1, "low rank": 10}.get(case, 32)
    np.testing.assert_allclose(values, want[: len(values)], rtol=1e-9, atol=1e-14 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]


def expected(vectors):
    """Whole numbers, exact deviations, covariance, and eigenpairs of a dense solver."""
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("kind", ["real", "edge", "empty"])
def test_query_equals_a_dense_solver(request, spark, kind):
    sf_dir = SF if kind == "real" else request.getfixturevalue(f"{kind}_dir")
    got = QUERIES["op13_whitening"](spark, sf_dir).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and len(v) != 2]
    if not usable:
        assert not got
        return
    deviation, centred, values, vectors = expected([v for _, v in usable])
    size = min(32, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == size * len(usable)
    assert {r["n"] for r in got} == {len(usable)} and {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] < 1e-9
    white = centred @ vectors[:, :size] / np.sqrt(values[:size])
    # Either sign is right, but one for all rows: signs are taken from the sum against the dense solver's.
    mine = {}
    for r in got:
        mine.setdefault(r["component"], []).append(r)
    for c, part in mine.items():
        assert part[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        ours = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in part)
        wanted = [(str(i), d, w) for (i, _), d, w in zip(usable, deviation, white[:, c - 1])]
        sign = np.sign(sum(r[2] ** 3 for r in ours) * sum(w[2] ** 3 for w in wanted))
        wanted = sorted((i, d, w * sign) for i, d, w in wanted)
        assert [r[:2] for r in ours] == [w[:2] for w in wanted]
        np.testing.assert_allclose([r[2] for r in ours], [w[2] for w in wanted], atol=1e-6)


def test_huge_entries_and_equal_vectors(spark):
    schema = "vec_id long, embedding array<float>, n long, component string"
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(5)], schema)
    assert whiten(same).count() == 0
    huge = spark.createDataFrame([(i, [float(3e38 if i % 2 else -3e38), float(i)], 1, "x") for i in range(6)], schema)
    rows = whiten(huge).collect()
    assert len(rows) == 6 * len({r["component"] for r in rows}) and {r["deviation"] for r in rows} == {None}
