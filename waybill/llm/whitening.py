"""Embedding whitening by a bidiagonal qd solver.

Method, step by step:

1. **Fit list.** Each entry ``c`` becomes the integer ``x = floor(256 c)``; every distinct x vector is
   kept once (a Spark ``distinct``, so a vector repeated by millions of rows is one row after the
   map-side combine). ``n`` vectors, per-dimension sums ``S``.
2. **Blockwise QR (TSQR).** Rows are centred exactly as integers ``y = n x - S``; every task folds its
   rows into a ``d x d`` triangle R with numpy's QR, and the triangles are stacked and reduced again
   in groups of ``FAN_IN`` until one is left. ``R^T R = Y^T Y``, so the covariance is
   ``V = R^T R / n^3`` without ever forming ``Y^T Y``.
3. **Householder bidiagonalisation** of R on the driver (``d x d``): ``R = U B W^T``.
4. **dqds** (differential qd with shifts, deflation at the bottom) gives the squared singular values
   of B, i.e. the eigenvalues of ``B^T B``, to high relative accuracy.
5. **Twisted factorisations.** For each wanted eigenvalue, the stationary and progressive
   factorisations of ``L D L^T - lambda`` (``L D L^T = B^T B`` is the qd array itself) meet at the
   twist index of least ``|gamma|``; solving from there gives the eigenvector z, and ``W z`` the
   whitening direction.

Only ``d x d`` matrices (one per task, then one) reach the driver; everything that grows with the
rows runs in Spark.

Defined results for odd input:

- A row whose vector is null, holds a null, NaN or infinite entry, or an entry with
  ``|256 c| >= 2^31`` (beyond what exact integer centring in doubles allows) is dropped.
- Vectors of another length than the most common one (ties: the longer) are dropped.
- Components are those with eigenvalue above ``2^-40`` times the largest, at most ``components``;
  with no rows, one distinct vector or all vectors equal there are none, and the result is empty.
- Repeated rows count once in the fit and are all whitened; the sign of each component is chosen so
  that its entry of largest magnitude is positive.
- Column names of the input do not matter: internal columns get names that none of its columns has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.sources.scratch import stored

FAN_IN = 32
LIMIT = 2**31
RELATIVE_FLOOR = 2.0**-40


def fresh(columns: list[str], base: str) -> str:
    """A column name that none of the given columns has."""
    taken = {c.lower() for c in columns}
    name, i = f"_{base}", 0
    while name.lower() in taken:
        i += 1
        name = f"_{base}{i}"
    return name


def integer_vector(vector: Column) -> Column:
    """``floor(256 c)`` of every entry as int, or null when the vector is malformed."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * 256.0) >= float(LIMIT)))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda c: F.floor(c.cast("double") * 256.0).cast("int")))


# ---------------------------------------------------------------------------------------------
# Driver side: d x d linear algebra


def _house(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A Householder vector v and beta with ``(I - beta v v^T) x = alpha e_1``."""
    v = x.astype(float).copy()
    norm = float(np.linalg.norm(v))
    if norm == 0.0:
        return v, 0.0
    alpha = -math.copysign(norm, v[0]) if v[0] != 0 else -norm
    v[0] -= alpha
    vv = float(v @ v)
    return v, (2.0 / vv if vv else 0.0)


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor W of ``a = U B W^T`` by Householder reflections."""
    a = np.array(a, dtype=float)
    m, n = a.shape
    w = np.eye(n)
    for k in range(n):
        v, beta = _house(a[k:, k])
        if beta:
            a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _house(a[k, k + 1 :])
            if beta:
                a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
                w[:, k + 1 :] -= beta * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _dqds_step(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform with shift tau, or None if it loses positivity (tau too large)."""
    n = len(q)
    qq, ee = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - tau
    if d < 0:
        return None
    for i in range(n - 1):
        qq[i] = d + e[i]
        if qq[i] <= 0:
            return None
        t = q[i + 1] / qq[i]
        ee[i] = e[i] * t
        d = d * t - tau
        if d < 0:
            return None
    qq[n - 1] = d
    return qq, ee


def dqds(q: list[float], e: list[float], most_steps: int = 200_000) -> list[float]:
    """Eigenvalues of ``B^T B`` from its qd array (q = squared diagonal, e = squared superdiagonal)."""
    eps = np.finfo(float).eps
    out: list[float] = []
    blocks = [(list(q), list(e), 0.0)]
    steps = 0
    while blocks:
        q, e, sigma = blocks.pop()
        while q:
            n = len(q)
            if n == 1:
                out.append(q[0] + sigma)
                break
            split = next((i for i in range(n - 1) if e[i] <= eps * eps * (q[i] + q[i + 1] + sigma) or e[i] == 0.0), None)
            if split is not None and split < n - 2:
                blocks.append((q[split + 1 :], e[split + 1 :], sigma))
                q, e = q[: split + 1], e[:split]
                continue
            if e[n - 2] <= eps * (sigma + q[n - 1]) * 1e-2 or e[n - 2] == 0.0:
                out.append(q[n - 1] + sigma)
                q, e = q[:-1], e[:-1]
                continue
            steps += 1
            if steps > most_steps:
                raise ArithmeticError("dqds did not converge")
            tau = 0.95 * min(q[n - 1], min(q))
            moved = None
            for _ in range(60):
                moved = _dqds_step(q, e, tau)
                if moved is not None:
                    break
                tau *= 0.25
            if moved is None:
                tau, moved = 0.0, _dqds_step(q, e, 0.0)
            if moved is None:  # a zero pivot: the bottom value is zero to working precision
                out.append(sigma)
                q, e = q[:-1], e[:-1]
                continue
            q, e = moved
            sigma += tau
    return sorted(out, reverse=True)


def twisted_vector(diag: np.ndarray, sup: np.ndarray, lam: float) -> np.ndarray:
    """Unit eigenvector of ``B^T B`` for eigenvalue lam by a twisted factorisation of ``L D L^T - lam``."""
    n = len(diag)
    tiny = np.finfo(float).tiny
    d = diag.astype(float) ** 2
    safe = np.where(diag == 0, tiny, diag)
    ell = sup / safe[:-1] if n > 1 else np.zeros(0)
    # stationary: L D L^T - lam = L+ D+ L+^T
    s = np.zeros(n)
    lp = np.zeros(max(n - 1, 0))
    s[0] = -lam
    for i in range(n - 1):
        dp = d[i] + s[i]
        dp = dp if dp != 0 else tiny
        lp[i] = d[i] * ell[i] / dp
        s[i + 1] = lp[i] * ell[i] * s[i] - lam
    # progressive: L D L^T - lam = U- D- U-^T
    p = np.zeros(n)
    um = np.zeros(max(n - 1, 0))
    p[n - 1] = d[n - 1] - lam
    for i in range(n - 2, -1, -1):
        dm = d[i] * ell[i] ** 2 + p[i + 1]
        dm = dm if dm != 0 else tiny
        t = d[i] / dm
        um[i] = ell[i] * t
        p[i] = p[i + 1] * t - lam
    gamma = s + p + lam
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -um[i] * z[i]
    return z / np.linalg.norm(z)


@dataclass(frozen=True)
class Fit:
    """What whitening needs: n, S, the components and their eigenvalues, the trace of V."""

    dims: int
    n: int
    sums: list[int]
    vectors: list[list[float]]
    values: list[float]
    trace: float


def solve(r: np.ndarray, n: int, sums: list[int], total_deviation: int, components: int) -> Fit:
    """Components of ``V = R^T R / n^3`` by bidiagonalisation, dqds and twisted factorisations."""
    dims = len(sums)
    trace = total_deviation / float(n) ** 3 if n else 0.0
    if n < 2 or not np.any(r):
        return Fit(dims, n, sums, [], [], trace)
    diag, sup, w = bidiagonalise(r)
    lams = dqds(list(diag**2), list(sup**2))
    top = lams[0]
    vectors, values = [], []
    for lam in lams[:components]:
        if lam <= top * RELATIVE_FLOOR:
            break
        v = w @ twisted_vector(diag, sup, lam)
        v = v * (1.0 if v[int(np.argmax(np.abs(v)))] > 0 else -1.0)
        vectors.append([float(c) for c in v])
        values.append(lam / float(n) ** 3)
    return Fit(dims, n, sums, vectors, values, trace)


# ---------------------------------------------------------------------------------------------
# Spark side


def _folded(n: int, sums: list[int], x_name: str):
    """Each task folds its centred rows into one triangle, numbered by its partition."""
    total = np.array(sums, dtype=np.int64)
    dims = len(sums)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        r = np.zeros((0, dims))
        for frame in frames:
            if len(frame) == 0:
                continue
            x = np.stack(frame[x_name].to_numpy()).astype(np.int64)
            y = (np.int64(n) * x - total).astype(float)
            r = np.linalg.qr(np.vstack([r, y]), mode="r")
        if len(r):
            flat = np.pad(r, ((0, dims - len(r)), (0, 0))).ravel().tolist()
            yield pd.DataFrame({"block": [TaskContext.get().partitionId()], "r": [flat]})

    return fold


def _stacked(dims: int):
    """The triangle of a group of at most FAN_IN stacked triangles."""

    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        stack = np.vstack([np.asarray(v, dtype=float).reshape(dims, dims) for v in frame["r"]])
        r = np.linalg.qr(stack, mode="r")
        flat = np.pad(r, ((0, dims - len(r)), (0, 0))).ravel().tolist()
        return pd.DataFrame({"block": [int(frame["g"].iloc[0])], "r": [flat]})

    return reduce


def triangle(fit_list: DataFrame, x_name: str, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list by a tree of QR factorisations, FAN_IN triangles at a time.

    Level 0 has one triangle per task of the fit list; each further level groups blocks
    ``FAN_IN`` at a time, so no task holds more than ``FAN_IN`` triangles of ``d x d``.
    """
    dims = len(sums)
    level = stored(fit_list.select(x_name).mapInPandas(_folded(n, sums, x_name), "block long, r array<double>"), "tsqr")
    while True:
        blocks = level.count()
        if blocks <= 1:
            rows = level.collect()
            return np.asarray(rows[0]["r"], dtype=float).reshape(dims, dims) if rows else np.zeros((dims, dims))
        grouped = level.select(F.floor(F.col("block") / FAN_IN).alias("g"), "r").groupBy("g")
        level = stored(grouped.applyInPandas(_stacked(dims), "block long, r array<double>"), "tsqr")


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 4) -> tuple[DataFrame, Fit, float]:
    """Remaining rows with ``whitened`` (array of doubles, one per component), the fit and its check.

    The third value is the largest absolute entry of the whitened fit list's covariance minus the
    identity, computed in Spark from the whitened rows themselves.
    """
    x_name = fresh(embeddings.columns, "x")
    kept = embeddings.withColumn(x_name, integer_vector(F.col(vector))).where(F.col(x_name).isNotNull())
    distinct = stored(kept.select(x_name).distinct(), "fitlist")
    sizes = distinct.groupBy(F.size(x_name).alias("d")).count().collect()
    if not sizes:
        return _whitened(kept.limit(0), x_name, Fit(0, 0, [], [], [], 0.0)), Fit(0, 0, [], [], [], 0.0), 0.0
    dims = max(sizes, key=lambda r: (r["count"], r["d"]))["d"]
    fit_list = distinct.where(F.size(x_name) == dims)
    kept = kept.where(F.size(x_name) == dims)
    pos = fresh(embeddings.columns, "pos")
    val = fresh(embeddings.columns, "val")
    sums_rows = fit_list.select(F.posexplode(x_name).alias(pos, val)).groupBy(pos).agg(F.sum(F.col(val).cast("long")).alias("s")).collect()
    n = fit_list.count()
    sums = [0] * dims
    for row in sums_rows:
        sums[row[pos]] = int(row["s"])
    total_deviation = int(fit_list.select(_deviation(x_name, n, sums).alias("dev")).agg(F.sum(F.col("dev").cast("decimal(38,0)"))).first()[0] or 0)
    r = triangle(fit_list, x_name, n, sums)
    fit = solve(r, n, sums, total_deviation, components)
    check = identity_error(_whitened(fit_list, x_name, fit), fit)
    return _whitened(kept, x_name, fit), fit, check


def _deviation(x_name: str, n: int, sums: list[int]) -> Column:
    """Sum over dimensions of ``(n x - S)^2``, exactly (decimal, cast to long at the end)."""
    s = F.array(*[F.lit(v).cast("decimal(38,0)") for v in sums])
    big = F.lit(n).cast("decimal(38,0)")
    centred = F.zip_with(F.col(x_name), s, lambda a, b: (big * a.cast("decimal(38,0)") - b).cast("decimal(38,0)"))
    terms = F.transform(centred, lambda t: (t * t).cast("decimal(38,0)"))
    return F.aggregate(terms, F.lit(0).cast("decimal(38,0)"), lambda acc, t: (acc + t).cast("decimal(38,0)")).cast("long")


def _whitened(frame: DataFrame, x_name: str, fit: Fit) -> DataFrame:
    n = fit.n
    s = F.array(*[F.lit(v).cast("long") for v in fit.sums]) if fit.sums else F.array().cast("array<long>")
    centred = F.zip_with(F.col(x_name), s, lambda a, b: (F.lit(n).cast("long") * a.cast("long") - b).cast("double") / F.lit(float(max(n, 1))))
    projected = [
        F.aggregate(
            F.zip_with(centred, F.array(*[F.lit(c) for c in v]), lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t
        ) / F.lit(math.sqrt(e))
        for v, e in zip(fit.vectors, fit.values)
    ]
    return frame.withColumn("whitened", F.array(*projected) if projected else F.array().cast("array<double>")).withColumn(
        "deviation", _deviation(x_name, n, fit.sums) if fit.sums else F.lit(0).cast("long")
    ).drop(x_name)


def identity_error(whitened_fit_list: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance (divisor n) minus the identity."""
    k = len(fit.vectors)
    if k == 0:
        return 0.0
    w = F.col("whitened")
    sums = [F.sum(w[i]).alias(f"m{i}") for i in range(k)]
    products = [F.sum(w[i] * w[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    row = whitened_fit_list.agg(*sums, *products, F.count(F.lit(1)).alias("n")).first()
    n = row["n"]
    worst = 0.0
    for i in range(k):
        for j in range(i, k):
            cov = row[f"p{i}_{j}"] / n - (row[f"m{i}"] / n) * (row[f"m{j}"] / n)
            worst = max(worst, abs(cov - (1.0 if i == j else 0.0)))
    return worst


def report(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row per remaining row and component: key, component, n, deviation, whitened, explained, identity_error."""
    frame, fit, check = whiten(embeddings, vector, components)
    explained = [e / fit.trace for e in fit.values] if fit.trace else []
    part = fresh(frame.columns, "part")
    if explained:
        per = F.arrays_zip(
            F.sequence(F.lit(1), F.lit(len(explained))).alias("component"),
            F.col("whitened").alias("whitened"),
            F.array(*[F.lit(x) for x in explained]).alias("explained"),
        )
    else:
        per = F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    return (
        frame.select(F.col(key), "deviation", F.explode(per).alias(part))
        .where(F.col(f"{part}.whitened").isNotNull())
        .select(
            F.col(key),
            F.col(f"{part}.component").cast("int").alias("component"),
            F.lit(fit.n).cast("long").alias("n"),
            F.col("deviation"),
            F.col(f"{part}.whitened").alias("whitened"),
            F.col(f"{part}.explained").alias("explained"),
            F.lit(check).cast("double").alias("identity_error"),
        )
    )
