"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

The fit table holds each distinct integer vector once, written to the shared folder. With its centred rows X,
a run starts from a vector v and alternates u = Xv - beta * u' and v' = Xᵀu - alpha * v, both normalised and
reorthogonalised in full against all earlier ones, which gives X V = U B with a bidiagonal B. A u is as long as
the table, so it is never gathered: u = Xw for a vector w of the dimension's length that follows from the
recurrence (u's products with earlier ones are those of w with Xᵀu, which are known). One pass over the table
makes a batch's rows of u and adds their Xᵀu; only numbers of the dimension's length reach the driver.

A run ends when the leading triplets of B have residuals of rounding size (or it spans the whole space). As one start
vector sees one direction only of a multiple singular value, further runs in what is orthogonal to the found
triplets follow until such a run has nothing larger than the smallest component asked for.

Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and rows of another dimension
than the most frequent one (of equally frequent ones the largest). Repeated vectors count once in the fit, and every
row of them is returned. Components without variance have null ``whitened``; without any usable row the result
is empty; one distinct vector alone has variance 0, so ``explained`` and ``whitened`` are null and the error is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import limit_batches, shared_path

EPS = np.finfo(float).eps


def usable(vectors: DataFrame, grid: int = 256) -> DataFrame:
    """(vec_id, x array<long>): x = floor(grid * entry) of each usable row; rows of one dimension."""
    v = F.col("embedding")

    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    entries = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.transform(v, lambda c: c.cast("double")).alias("embedding"))
    good = entries.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad))
    rows = good.select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(grid)))).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == F.lit(common[0]["d"] if common else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A batch's vectors of one length as rows."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _totals(fit: DataFrame, part, kind: str) -> np.ndarray:
    """Sums over all rows of what ``part(rows)`` gives for a batch, added up by position in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                got = part(matrix(b.column(0)))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

    sums = fit.select("x").mapInArrow(run, f"i int, s {kind}").groupBy("i").agg(F.sum("s").alias("s"))
    return np.array([r["s"] for r in sorted(sums.collect())])


@dataclass
class Basis:
    """Right vectors v, with u = Xw and h = Xᵀu of each left vector u."""

    v: list = field(default_factory=list)
    w: list = field(default_factory=list)
    h: list = field(default_factory=list)


def _clear(z: np.ndarray, of: list) -> np.ndarray:
    """z without its parts along the unit vectors ``of``; twice, as once leaves rounding."""
    q = np.array(of)
    for _ in range(2 if of else 0):
        z = z - q.T @ (q @ z)
    return z


def _clear_left(w: np.ndarray, base: Basis) -> np.ndarray:
    """The w of Xw without its parts along the left vectors so far."""
    h, ws = np.array(base.h), np.array(base.w)
    for _ in range(2 if base.w else 0):
        w = w - ws.T @ (h @ w)
    return w


def _run(product, locked: Basis, d: int, scale: float, rng, wanted: int, beyond: float | None):
    """One bidiagonalisation orthogonal to ``locked``: its triplets (sigma, v, w), and whether it spans the rest.

    It ends when ``wanted`` triplets have settled, or, with ``beyond``, when its largest value is known to be less.
    """
    base = Basis(list(locked.v), list(locked.w), list(locked.h))
    first, alphas, betas = len(locked.v), [], []
    z = _clear(rng.standard_normal(d), base.v)
    base.v.append(z / np.linalg.norm(z))
    w = base.v[-1]
    while True:
        w = _clear_left(w, base)
        g, square = product(w)
        alpha = float(np.sqrt(square))
        alphas.append(alpha)
        dead = alpha <= EPS * d * scale * max(1.0, float(np.linalg.norm(w)))  # Xv lies in what is spanned already
        base.w.append(np.zeros(d) if dead else w / alpha)
        base.h.append(np.zeros(d) if dead else g / alpha)
        if dead:
            alphas[-1] = 0.0
        z = _clear(base.h[-1] - alphas[-1] * base.v[-1], base.v)
        beta, k = float(np.linalg.norm(z)), len(alphas)
        spans = len(base.v) >= d
        b = np.diag(alphas) + np.diag(betas, 1)
        p, sigma, qt = np.linalg.svd(b)
        ends = spans or beta <= EPS * d * scale
        rest = np.zeros(k) if ends else np.abs(beta * p[-1])
        settled = rest <= 8 * EPS * sigma[0]
        if beyond is not None:
            ends = ends or sigma[0] + 10 * rest[0] < beyond
        if ends or (beyond is None or sigma[0] >= beyond) and k >= wanted and settled[:wanted].all():
            v, ws = np.array(base.v[first:]), np.array(base.w[first:])
            keep = [i for i in range(k) if spans or settled[i]]
            return [(sigma[i], qt[i] @ v, p[:, i] @ ws) for i in keep], spans
        base.v.append(z / beta)
        betas.append(beta)
        w = base.v[-1] - beta * base.w[-1]


def leading(product, d: int, k: int, scale: float, seed: int = 0) -> list[tuple[float, np.ndarray]]:
    """The k largest singular values of X with their right vectors; ``product(w)`` gives XᵀXw and |Xw|².

    ``scale`` is X's Frobenius norm: what is that small beside it is rounding.
    """
    rng, locked, sigmas = np.random.default_rng(seed), Basis(), []
    k = min(k, d)
    while True:
        beyond = sorted(sigmas)[-k] if len(sigmas) >= k else None
        found, spans = _run(product, locked, d, scale, rng, min(k, d - len(locked.v)), beyond)
        for sigma, v, w in found:
            v = _clear(v, locked.v)
            locked.v.append(v / np.linalg.norm(v))
            locked.w.append(w)
            locked.h.append(sigma * v)
            sigmas.append(float(sigma))
        done = beyond is not None and (not found or max(f[0] for f in found) < beyond)
        if spans or done or len(locked.v) >= d:
            order = np.argsort(-np.array(sigmas), kind="stable")[:k]
            return [(sigmas[i], locked.v[i]) for i in order]


@dataclass
class Model:
    """What the fit learnt; all of the dimension's length."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: list
    identity_error: float


def fit(rows: DataFrame, k: int = 4) -> Model | None:
    """The whitening model of (vec_id, x) rows, each distinct x once; None without rows."""
    limit_batches(rows.sparkSession)
    path = shared_path(rows.sparkSession, "whitening")
    rows.select("x").distinct().write.parquet(path)
    table = rows.sparkSession.read.parquet(path)
    counted = _totals(table, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not len(counted):
        return None
    n, sums = int(counted[-1]), counted[:-1]
    mean, d = sums / n, len(sums)

    def product(w):
        def part(x):
            c = x - mean
            u = c @ w
            return np.append(c.T @ u, u @ u)

        got = _totals(table, part, "double")
        return got[:-1], got[-1]

    trace = float(_totals(table, lambda x: ((x - mean) ** 2).sum(axis=0), "double").sum()) / n
    triplets = leading(product, d, k, float(np.sqrt(trace * n))) if trace > 0 else [(0.0, e) for e in np.eye(d)[:k]]
    sigma, v = np.array([s for s, _ in triplets]), np.array([x for _, x in triplets])
    values = np.where(sigma > EPS * d * max(sigma[0], n ** 0.5), sigma, 0) ** 2 / n
    live = values > 0

    def gram(x):
        y = (x - mean) @ (v[live] / np.sqrt(values[live])[:, None]).T
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    error = 0.0
    if live.any():
        got, m = _totals(table, gram, "double") / n, int(live.sum())
        cov = got[:m * m].reshape(m, m) - np.outer(got[m * m:], got[m * m:])
        error = float(np.abs(cov - np.eye(m)).max())
    return Model(n, sums, values, v, [float(e / trace) if trace > 0 else None for e in values], error)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact sums over dimensions of (n * x - S)²; null where a long cannot hold one."""
    largest = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if x.shape[1] * largest * largest < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    own = [sum((n * a - s) ** 2 for a, s in zip(r, sums.tolist(), strict=True)) for r in x.tolist()]
    return [v if v < 1 << 63 else None for v in own]


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, k: int = 4, grid: int = 256) -> DataFrame:
    """One row for each usable vector and component: see ``SCHEMA``."""
    spark = vectors.sparkSession
    rows = usable(vectors, grid)
    m = fit(rows, k)
    if m is None:
        return spark.createDataFrame([], SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = np.where(m.eigenvalues > 0, np.sqrt(m.eigenvalues), np.nan)
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for b in batches:
            if not b.num_rows:
                continue
            x, c, rep = matrix(b.column(1)), len(m.eigenvalues), b.num_rows
            y = ((x - m.sums / m.n) @ m.components.T) / scale
            ids = pa.array(np.repeat(np.arange(rep), c))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(ids), pa.array(np.tile(np.arange(1, c + 1), rep), pa.int32()),
                pa.array(np.full(rep * c, m.n), pa.int64()),
                pa.array(_deviations(x, m.n, m.sums), pa.int64()).take(ids),
                pa.array(y.ravel(), pa.float64(), mask=np.isnan(y.ravel())),
                pa.array(m.explained * rep, pa.float64()), pa.array(np.full(rep * c, m.identity_error))], names)

    return rows.mapInArrow(run, SCHEMA)
