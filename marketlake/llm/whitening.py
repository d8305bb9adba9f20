"""Whitening of integer-scaled embeddings by FEAST.

Every entry c becomes x = floor(scale * c). The fit list holds each distinct x
vector once; its count, sums, covariance and the covariance of the whitened
values come from passes over it, each task sending one small partial per
dimension. The leading eigenpairs of the covariance (dimension by dimension, so
bounded by the vectors' length) are found by contour integration: inertia
counts of shifted covariances give intervals with a known number of
eigenvalues; a quadrature of complex shifted solves filters a subspace onto
each interval; Rayleigh-Ritz extracts the pairs, and the subspace grows until
it has as many pairs as the inertia counts say.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import rows
from marketlake.session import scratch_path

SCALE = 256
COMPONENTS = 4
#: Gauss-Legendre nodes on the upper half of a contour, and eigenvalues of an interval at most (ties may be more).
NODES, PER_INTERVAL = 8, 32
#: Exact squares are summed in two halves of so many bits.
_HALF = 26


# --- eigenpairs -------------------------------------------------------------------

def n_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the symmetric factorisation of ``matrix - shift``.

    Diagonal pivoting with blocks of one and two rows; by Sylvester's law the
    pivots have the signs of the eigenvalues. A pivot of zero counts as none.
    """
    a = matrix - shift * np.eye(len(matrix))
    found = 0
    while len(a):
        off = np.abs(np.tril(a, -1))
        i, j = divmod(int(off.argmax()), len(a))
        p = int(np.abs(np.diag(a)).argmax())
        if abs(a[p, p]) >= 0.6404 * off[i, j]:
            if a[p, p] == 0:
                return found
            found += a[p, p] > 0
            keep = np.arange(len(a)) != p
            c = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(c, c) / a[p, p]
        else:
            # a block with a larger off-diagonal entry has one positive and one negative eigenvalue
            found += 1
            keep = ~np.isin(np.arange(len(a)), (i, j))
            c = a[np.ix_(keep, [i, j])]
            a = a[np.ix_(keep, keep)] - c @ np.linalg.solve(a[np.ix_([i, j], [i, j])], c.T)
        a = (a + a.T) / 2
    return found


def _split(matrix: np.ndarray, low: float, n_low: int, high: float, n_high: int, least: float,
           most: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues) from the top, of at most ``most`` eigenvalues unless they are closer than ``least``."""
    if n_low == n_high:
        return []
    if n_low - n_high <= most or high - low <= least:
        return [(low, high, n_low - n_high)]
    mid = (low + high) / 2
    n_mid = n_above(matrix, mid)
    return (_split(matrix, mid, n_mid, high, n_high, least, most)
            + _split(matrix, low, n_low, mid, n_mid, least, most))


def _interval_pairs(matrix: np.ndarray, low: float, high: float, n: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs in (low, high], largest first."""
    d, norm = len(matrix), np.abs(matrix).sum(axis=1).max()
    centre, radius = (low + high) / 2, (high - low) / 2 or np.spacing(norm)
    x, w = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(0.5j * np.pi * (x + 1))
    size = min(d, n + max(8, n // 2))
    rng = np.random.default_rng(d)
    basis = rng.standard_normal((d, size))
    for step in range(200):
        if size < d:
            # (1 / 2 pi i) of the integral of (z - V)^-1 over the circle, by its upper half
            basis = sum(wk * radius * (t * np.linalg.solve((centre + radius * t) * np.eye(d) - matrix, basis)).real
                        for wk, t in zip(w / 2, turn))
        basis = np.linalg.qr(basis)[0]
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ inner
        inside = np.flatnonzero((values > low) & (values <= high))
        rest = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
        if size == d and len(inside) != n:  # an eigenvalue within rounding of an end
            inside = np.argsort(np.abs(values - centre), kind="stable")[:n]
            rest = np.zeros(0)
        if len(inside) == n and (rest <= 64 * np.finfo(float).eps * norm).all():
            order = inside[np.argsort(-values[inside], kind="stable")]
            return values[order], vectors[:, order]
        basis = vectors
        if step % 8 == 7 and size < d:  # slow: the eigenvalues next to the interval need room as well
            more = min(d, 2 * size) - size
            basis = np.hstack([basis, rng.standard_normal((d, more))])
            size += more
    raise ArithmeticError(f"{len(inside)} of {n} eigenpairs found between {low} and {high}")


def leading_pairs(matrix: np.ndarray, k: int, *, nodes: int = NODES,
                  per_interval: int = PER_INTERVAL) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns.

    Eigenvalues within rounding of zero are left out, so there may be fewer.
    """
    matrix = (matrix + matrix.T) / 2
    d, norm = len(matrix), float(np.abs(matrix).sum(axis=1).max(initial=0))
    zero = 4 * d * np.finfo(float).eps * norm
    k = min(k, n_above(matrix, zero)) if norm else 0
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    top, least = norm * (1 + 1e-9), 16 * np.finfo(float).eps * norm

    def edge(count: int) -> tuple[float, float]:
        """Around the place above which there are fewer than ``count`` eigenvalues."""
        a, b = zero, top
        while b - a > least:
            mid = (a + b) / 2
            a, b = (mid, b) if n_above(matrix, mid) >= count else (a, mid)
        return a, b

    below_last = edge(k)[0]
    n_low = n_above(matrix, below_last)  # more than k if the last ones are equal
    next_up = edge(n_low + 1)[1] if n_low < d else zero
    low = (next_up + below_last) / 2 if next_up < below_last else below_last
    high = edge(1)[1]
    high += max(least, 0.01 * (high - low))
    intervals = _split(matrix, low, n_above(matrix, low), high, 0, least, per_interval)
    found = [_interval_pairs(matrix, a, b, n, nodes) for a, b, n in intervals]
    values, vectors = np.concatenate([v for v, _ in found]), np.hstack([u for _, u in found])
    if len(values) != n_above(matrix, low):
        raise ArithmeticError("the inertia counts name more eigenvalues than were found")
    return values[:k], vectors[:, :k]


# --- Spark ------------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of equally long lists."""
    lists = column.flatten()
    return lists.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scaled(df: DataFrame, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``df`` without rows whose vector is null or has null or non-finite entries; column ``x`` instead of ``vec_col``.

    Shorter vectors are filled with zeros to the longest; entries beyond 64 bits stop at the largest long.
    """
    v = F.col(vec_col)
    ok = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                  & (F.abs(c.cast("double")) < float("inf")))
    kept = df.where(ok)
    d = kept.agg(F.max(F.size(v))).first()[0] or 0
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    missing = F.lit(d) - F.size(v)
    x = F.when(missing > 0, F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), missing.cast("int")))).otherwise(x)
    return kept.withColumn(vec_col, x).withColumnRenamed(vec_col, "x")


def _added(df: DataFrame, kind: str) -> dict[int, list]:
    """Sums of the rows (i, v array) by i, few on each side: tasks have added their own rows up already."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        exact = kind.startswith("decimal")
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.array([int(y) for y in v] if exact else v, dtype=object if exact else float)
                total[i] = total[i] + v if i in total else v
        for i, v in total.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([[str(y) for y in v] if exact else v.tolist()])],
                                  names=["i", "v"])

    out = "string" if kind.startswith("decimal") else "double"
    got = df.repartition("i").mapInArrow(add, f"i int, v array<{out}>").collect()
    return {r.i: list(r.v) for r in got}


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of every dimension."""

    def sums(batches):
        n, total = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(0))
            big = np.abs(x.astype(float)).max(initial=0) * len(x) >= 2.0**62
            s = x.astype(object).sum(axis=0) if big else x.sum(axis=0).astype(object)
            n, total = n + len(x), s if total is None else total + s
        if n:
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([[str(n), *map(str, total)]])], names=["i", "v"])

    got = _added(fit.select("x").mapInArrow(sums, "i int, v array<string>"), "decimal(38,0)")
    return (int(got[0][0]), [int(s) for s in got[0][1:]]) if got else (0, [])


def covariance(fit: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the fit list, centred before multiplying; of its projections if ``basis`` is given."""

    def products(batches):
        first = second = None
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b.column(0)) - mean
            y = y if basis is None else y @ basis
            first = y.sum(axis=0) if first is None else first + y.sum(axis=0)
            second = y.T @ y if second is None else second + y.T @ y
        if first is not None:
            # row -1: what rounding has left of the mean
            parts = [first, *second]
            yield pa.record_batch([pa.array(range(-1, len(first)), pa.int32()), pa.array([p.tolist() for p in parts])],
                                  names=["i", "v"])

    got = _added(fit.select("x").mapInArrow(products, "i int, v array<double>"), "double")
    left = np.array(got[-1]) / n
    return np.array([got[i] for i in range(len(left))]) / n - np.outer(left, left)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sum over dimensions of (n x - S)^2 for each row."""
    if max(n * np.abs(x.astype(float)).max(initial=0), np.abs(sums.astype(float)).max(initial=0)) >= 2.0**51:
        u = x.astype(object) * n - sums
        return [int(s) for s in (u * u).sum(axis=1)]
    u = np.abs(x * n - sums.astype(np.int64))
    hi, lo = u >> _HALF, u & ((1 << _HALF) - 1)
    square = [(a * b).sum(axis=1).tolist() for a, b in ((hi, hi), (hi, lo), (lo, lo))]
    return [(a << 2 * _HALF) + (b << _HALF + 1) + c for a, b, c in zip(*square)]


def whiten(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """One row for each kept row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null, NaN or infinite entry are
    dropped; shorter vectors count as filled with zeros. Repeated vectors enter
    the fit once but all rows come back. Components with an eigenvalue within
    rounding of zero are left out, so equal vectors, a single one, or an empty
    table give no rows. ``deviation`` is null where it passes 64 bits;
    ``deviation_exact`` (38 digits) is not. Other columns of ``df`` are not
    carried, so their names cannot clash.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    x = scaled(df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "v", scale).select("id", "x")
    path = scratch_path(spark, "whitening")
    x.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    n, sums = moments(fit)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    v = covariance(fit, n, mean) if sums else np.zeros((0, 0))
    values, vectors = leading_pairs(v, components)
    basis = vectors / np.sqrt(values)
    error = float(np.abs(covariance(fit, n, mean, basis) - np.eye(len(values))).max()) if len(values) else 0.0
    # the trace of the covariance is the sum of all eigenvalues
    explained = (values / math.fsum(np.diag(v))).tolist()
    exact_sums, k = np.array(sums, dtype=object), len(values)
    out = (f"{id_col} {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, "
           "identity_error double, deviation_exact decimal(38,0)")

    def project(batches):
        for b in batches:
            if not b.num_rows or not k:
                continue
            m = _matrix(b.column(1))
            dev = _deviations(m, n, exact_sums)
            w = (m - mean) @ basis
            rep = pa.array(np.repeat(np.arange(len(m)), k))
            schema = pa.schema([(id_col, b.column(0).type), ("component", pa.int32()), ("n", pa.int64()),
                                ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()),
                                ("identity_error", pa.float64()), ("deviation_exact", pa.decimal128(38, 0))])
            exact = pa.array([x if x < 10**38 else None for x in dev], pa.decimal128(38, 0))
            yield rows(schema, b.column(0).take(rep), np.tile(np.arange(1, k + 1, dtype=np.int32), len(m)),
                       np.full(len(rep), n), pa.array([x if x < 2**63 else None for x in dev], pa.int64()).take(rep),
                       w.ravel(), explained * len(m), [error] * len(rep), exact.take(rep))

    return x.mapInArrow(project, out)
