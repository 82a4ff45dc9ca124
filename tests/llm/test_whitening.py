"""Whitening against numpy's eigenvectors and exact integer arithmetic."""

import math

import numpy as np
import pytest

from cartograph.llm import whitening as W
from tests.llm.conftest import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA).repartition(parts)


def brute(vectors, k):
    """n, exact deviations, eigenvalues, projections / sqrt(e), trace of the whole matrix."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dims)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(dims)) for r in x]
    d = np.array([[(n * r[j] - s[j]) / n for j in range(dims)] for r in x])
    cov = d.T @ d / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, dev, e, d @ v / np.sqrt(e), cov.trace()


@pytest.mark.parametrize("dims,k", [(20, 32), (40, 32), (6, 4)])
def test_components(spark, dims, k):
    rng = np.random.default_rng(dims)
    vectors = (rng.standard_normal((300, dims)) * np.linspace(0.2, 3, dims) + 5).astype(np.float32).tolist()
    vectors += vectors[:40]  # repeated rows count again
    got = W.components(clashing(frame(spark, vectors), ("component", "n", "whitened", "__v", "dims")), k).collect()
    n, dev, e, white, trace = brute(vectors, k)
    assert len(got) == n * min(k, dims)
    table = np.zeros_like(white)
    for r in got:
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]] and r["identity_error"] < 1e-9
        assert abs(r["explained"] - e[r["component"] - 1] / trace) < 1e-12
        table[r["vec_id"], r["component"] - 1] = r["whitened"]
    sign = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * sign).max() < 1e-9
    assert np.abs(table.T @ table / n - np.eye(min(k, dims))).max() < 1e-9


def test_left_out_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((50, 5)).astype(np.float32).tolist()
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [1e38] * 5]
    rows = [(i, v, None) for i, v in enumerate(good)] + [(None, good[0], 1)] + [(900 + i, v, 1) for i, v in enumerate(odd)]
    got = W.components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {None, *range(50)} and {r["n"] for r in got} == {51} and len(got) == 51 * 5
    same = [r["whitened"] for r in sorted(got, key=lambda r: r["component"]) if r["vec_id"] in (0, None)]
    assert same[::2] == same[1::2]


def test_tables_without_variance(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [None, []]):
        assert W.components(frame(spark, vectors)).collect() == []
    one = W.components(frame(spark, [[1.0, 2.0], [1.0, 4.0], [1.0, 6.0]])).collect()  # a single direction
    assert {r["component"] for r in one} == {1} and {r["explained"] for r in one} == {1.0} and one[0]["identity_error"] < 1e-12


def test_slow_exact_deviations():
    x = np.array([[1 << 40, 0], [0, 1 << 40]])
    whole, _ = W.centre(2, [1 << 40, 1 << 40])
    with pytest.raises(OverflowError):
        W.deviations(x, 2, [1 << 40, 1 << 40], whole)
    x = np.array([[3_100_000_000, 1], [0, 0]]) // 2
    sums = x.sum(axis=0).tolist()
    whole, _ = W.centre(2, sums)
    assert W.deviations(x, 2, sums, whole).tolist() == [sum((2 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]


def spectra():
    rng = np.random.default_rng(9)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    yield "ties", q @ np.diag([5.0] * 20 + [5 + 1e-12] * 3 + [1.0] * 10 + [1e-13] * 7) @ q.T, 33
    yield "identity", np.eye(8), 8
    yield "one", np.ones((50, 50)), 1
    yield "wide", np.diag(np.geomspace(1, 1e-9, 30)), 30
    b = rng.standard_normal((500, 64))
    yield "noise", b.T @ b / 500, 32
    yield "zero", np.zeros((4, 4)), 0


@pytest.mark.parametrize("name,matrix,rank", list(spectra()), ids=lambda p: p if isinstance(p, str) else "")
def test_leading_eigenpairs(name, matrix, rank):
    values, vectors = W.leading(matrix, rank or 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:rank]
    assert len(values) == rank and np.allclose(values, want, rtol=0, atol=1e-13 * max(1, *abs(want), 1))
    if rank:
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * want[0] * len(matrix)
        assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = rng.integers(1, 14)
        a = rng.integers(-2, 3, (n, n)).astype(float)
        a, shift = a + a.T, rng.choice([0.5, 0.0, 1.0, -1.3])
        e = np.linalg.eigvalsh(a)
        if np.abs(e - shift).min() > 1e-9:
            assert W.count_above(a, shift) == (e > shift).sum()


def test_a_missed_eigenvalue_is_noticed(monkeypatch):
    whole = W.slices
    monkeypatch.setattr(W, "slices", lambda m, k: [(a, b, c - 1) if i == 0 else (a, b, c) for i, (a, b, c) in enumerate(whole(m, k))])
    with pytest.raises(ArithmeticError):
        W.leading(np.diag(np.arange(1.0, 31)), 20)
