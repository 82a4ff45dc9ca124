"""Embedding whitening with components from FEAST contour integration.

Every entry c becomes the integer floor(64 c) + 1000000.  Sums are exact integers; the covariance is
summed from vectors centred first, as (x - m) - (S/n - m) with the mean rounded to integers m, so no digits
are lost to the offset.  Spark sums both over all vectors; only a matrix of dimension x dimension comes back.

Its leading eigenvectors are found on that matrix:

* spectrum slicing: the eigenvalues above a shift are counted by the inertia of the shifted matrix
  (symmetric elimination with Bunch-Parlett pivots); intervals are halved until they hold few of the
  wanted eigenvalues, at cuts that no eigenvalue is close to;
* contour integration: on a circle around each interval, Gauss-Legendre quadrature of solves with the
  complex shifted matrix projects a random subspace onto the interval's eigenvectors; Rayleigh-Ritz on
  that subspace, and again until the residuals are at rounding level;
* completeness: an interval must yield as many eigenvalues as the inertia counts say, else its subspace
  is widened; a last Rayleigh-Ritz over all intervals makes the components orthogonal to each other.

Defined results: rows whose vector is null, or holds null or non-finite entries (or ones of 2^40 or more)
are left out, and so are empty vectors and those of another length than the most frequent one (ties: the
longer one).  Components without variance (below 1e-10 of the first) do not exist, so a table of equal
rows, of one row or without rows gives no rows.  Ties between eigenvalues give some orthonormal basis,
the same for all rows; a component's largest entry is positive.  Repeated rows count again, a null key
stays null, extra columns are ignored; a deviation beyond 64 bits raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
LARGEST, LOW_BITS = 2.0 ** 40, 20
NODES, WIDE, TURNS, SEED = 8, 12, 60, 20_240_601
ACCURACY, CLEARANCE, RANK = 1e-13, 1e-9, 1e-10  # in units of the largest eigenvalue bound
ROWS = 1 << 20  # entries that a task turns to doubles at once


class Fit(NamedTuple):
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors in columns
    trace: float
    identity_error: float


# ---- eigenvalues of a symmetric matrix by slicing and contours -------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the symmetric elimination of matrix - shift."""
    a = matrix - shift * np.eye(len(matrix))
    alpha, positive = (1 + 17 ** 0.5) / 8, 0
    while len(a):
        size = np.abs(a)
        p = int(size.diagonal().argmax())
        r, s = divmod(int((size - np.diag(size.diagonal())).argmax()), len(a))
        if size[p, p] >= alpha * size[r, s]:
            if a[p, p] == 0:
                return positive  # all that is left is zero
            positive += a[p, p] > 0
            pivot = [p]
        else:
            positive += 1  # a block of two with a negative determinant: one of each sign
            pivot = [r, s]
        rest = np.delete(np.arange(len(a)), pivot)
        c = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(a[np.ix_(pivot, pivot)], c.T)
        a = (a + a.T) / 2
    return int(positive)


def slices(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, count), from the top, that hold the ``k`` largest eigenvalues."""
    radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
    low, high = float((matrix.diagonal() - radius).min()), float((matrix.diagonal() + radius).max())
    norm = max(abs(low), abs(high))
    low, high = low - CLEARANCE * norm, high + CLEARANCE * norm
    todo, out = [(low, high, len(matrix), 0)], []  # counts above low and above high
    while todo:
        a, b, above_a, above_b = todo.pop()
        if above_b >= k or above_a == above_b:
            continue
        if above_a - above_b <= WIDE or b - a <= 8 * CLEARANCE * norm:
            out.append((a, b, above_a - above_b))
            continue
        for part in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65):
            cut = a + part * (b - a)
            above = count_above(matrix, cut - CLEARANCE * norm)
            if above == count_above(matrix, cut + CLEARANCE * norm):
                break
        todo += [(a, cut, above_a, above), (cut, b, above, above_b)]
    return out


def ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``matrix`` within the span of ``basis``, falling."""
    q, _ = np.linalg.qr(basis)
    inner = q.T @ matrix @ q
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values[::-1], q @ turn[:, ::-1]


def contour(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """The ``count`` eigenvectors of eigenvalues in (low, high), by filtered subspace iteration."""
    n, norm = len(matrix), np.abs(matrix).sum(axis=1).max()
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (node + 1))  # upper half of the circle; the lower one is its conjugate
    centre, radius = (low + high) / 2, (high - low) / 2
    rng = np.random.default_rng(SEED)
    basis = rng.standard_normal((n, min(n, 2 * count + 8)))
    for _ in range(TURNS):
        image = np.zeros_like(basis)
        for e, w in zip(turn, weight):
            image += w * (radius * e * np.linalg.solve((centre + radius * e) * np.eye(n) - matrix, basis.astype(complex))).real
        values, basis = ritz(matrix, image)
        inside = np.flatnonzero((values > low) & (values < high))
        found = basis[:, inside]
        if len(inside) == count and np.abs(matrix @ found - found * values[inside]).max() <= ACCURACY * norm * n ** 0.5:
            return found
        if len(inside) > count and basis.shape[1] < n:  # Ritz values that no eigenvector stands behind yet
            basis = np.hstack([basis, rng.standard_normal((n, min(count, n - basis.shape[1])))])
    raise ArithmeticError(f"{len(inside)} of {count} eigenvalues found between {low} and {high}")


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (those without variance left out) and their unit eigenvectors."""
    k = min(k, len(matrix))
    if not k or not np.abs(matrix).max() > 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    parts = slices(matrix, k)
    values, vectors = ritz(matrix, np.hstack([contour(matrix, *p) for p in parts]))
    values, vectors = values[:k], vectors[:, :k]
    # inertia: as many eigenvalues lie above the lowest slice as were found in all
    if count_above(matrix, min(a for a, _, _ in parts)) != sum(c for _, _, c in parts):
        raise ArithmeticError("eigenvalues are missing")
    real = values > RANK * values[0]
    values, vectors = values[real], vectors[:, real]
    return values, vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0)


# ---- passes over the vectors -----------------------------------------------------------------


def fine_vectors(embeddings: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """key and __v (array of double) of the remaining rows, and their length."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall("__v", lambda c: c.isNotNull() & (F.abs(F.nanvl(c, F.lit(float("inf")))) < LARGEST))
    rows = embeddings.select(F.col(f"`{key}`").alias(key), v.alias("__v")).where(F.col("__v").isNotNull() & fine & (F.size("__v") > 0))
    size = F.size("__v").alias("dims")
    most = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = most["dims"] if most else 0
    return rows.where(F.size("__v") == dims), dims


def integers(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys and integer vectors, at most about ROWS entries at once."""
    step = max(1, ROWS // dims)
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            v = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield part.column(0), np.floor(SCALE * v).astype(np.int64) + OFFSET


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as integers and a remainder of at most one half."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([float(Fraction(s - n * m, n)) for s, m in zip(sums, whole)])


def moments(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum."""

    def add(batches):
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for _, x in integers(batches, dims):  # two halves: no sum leaves 64 bits
            n, high, low = n + len(x), high + (x >> LOW_BITS).sum(axis=0), low + (x & (1 << LOW_BITS) - 1).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)), pa.array(high), pa.array(low)],
                                         names=["i", "n", "high", "low"])

    parts = rows.mapInArrow(add, "i int, n long, high long, low long").groupBy("i").agg(
        *[F.sum(F.col(c).cast("decimal(19,0)")).alias(c) for c in ("n", "high", "low")])
    got = sorted(parts.collect())
    return int(got[0]["n"]), [int(r["high"]) * 2 ** LOW_BITS + int(r["low"]) for r in got]


def covariance(rows: DataFrame, dims: int, n: int, sums: list[int], project: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the centred vectors, projected first."""
    whole, rest = centre(n, sums)
    k = project.shape[1]

    def add(batches):
        total = np.zeros((k, k))
        for _, x in integers(batches, dims):
            d = ((x - whole) - rest) @ project
            total += d.T @ d
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    parts = rows.mapInArrow(add, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")) \
        .where("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((k, k))
    for r in parts.toLocalIterator():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
    return out


def fit(embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> Fit | None:
    """Whitening of all remaining vectors; None where there are none."""
    rows, dims = fine_vectors(embeddings, key, vector)
    if not dims:
        return None
    n, sums = moments(rows, dims)
    matrix = covariance(rows, dims, n, sums, np.eye(dims))
    values, vectors = leading(matrix, components)
    white = covariance(rows, dims, n, sums, vectors / np.sqrt(values))
    error = float(np.abs(white - np.eye(len(values))).max()) if len(values) else 0.0
    return Fit(n, sums, values, vectors, float(matrix.trace()), error)


def deviations(x: np.ndarray, n: int, sums: list[int], whole: np.ndarray) -> np.ndarray:
    """Exact sums over dimensions of (n x - S)^2."""
    rest = np.array([s - n * m for s, m in zip(sums, whole.tolist())], object)
    if ((n * (x - whole).astype(float) - rest.astype(float)) ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
        y = n * (x - whole) - rest.astype(np.int64)
        return (y * y).sum(axis=1)
    y = n * (x - whole).astype(object) - rest
    out = (y * y).sum(axis=1)
    if max(out) >= 2 ** 63:
        raise OverflowError("a deviation does not fit a long")
    return out.astype(np.int64)


def whiten(embeddings: DataFrame, fitted: Fit | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, deviation, whitened (array of double, one entry a component) of every remaining row."""
    name, kind = key, embeddings.schema[key].dataType.simpleString()
    schema = f"`{name}` {kind}, deviation long, whitened array<double>"
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    rows, dims = fine_vectors(embeddings, key, vector)
    n, sums = fitted.n, fitted.sums
    whole, rest = centre(n, sums)
    project = fitted.vectors / np.sqrt(fitted.values)

    def apply(batches):
        for keys, x in integers(batches, dims):
            w = ((x - whole) - rest) @ project
            starts = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(deviations(x, n, sums, whole)), pa.ListArray.from_arrays(starts, pa.array(w.ravel()))],
                names=[name, "deviation", "whitened"])

    return rows.mapInArrow(apply, schema)


def components(embeddings: DataFrame, k: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error of every remaining row and component."""
    fitted = fit(embeddings, k, key, vector)
    rows = whiten(embeddings, fitted, key, vector)
    share = fitted.values / fitted.trace if fitted is not None and len(fitted.values) else []
    explained = F.array(*[F.lit(float(s)) for s in share]).cast("array<double>")
    return rows.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key, (F.col("at") + 1).alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))
