"""op13: whitening against numpy's eigendecomposition, with odd rows."""

import math

import numpy as np
import pytest

from waybill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, _x string, whitened string, deviation string"


def vectors(m=120, d=6, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(m, d)) * np.array([3, 2, 1.5, 1, 0.5, 0.25])[:d]).astype(np.float32)


def brute(rows, k=4):
    """Plain numpy: the contract's numbers for the rows that remain."""
    kept = [(i, np.floor(np.asarray(v, dtype=np.float64) * 256).astype(np.int64)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    cov = c.T @ c / n
    ev, vec = np.linalg.eigh(cov)
    ev, vec = ev[::-1], vec[:, ::-1]
    out = {}
    for (i, v) in kept:
        for j in range(k):
            out[(i, j + 1)] = (n, int(((n * v - s) ** 2).sum()), float((v - s / n) @ vec[:, j] / math.sqrt(ev[j])), ev[j] / ev.sum())
    return out


def test_whitening_matches_eigh(spark):
    base = vectors()
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1004, [float("nan")] * 6),
             (1005, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (1006, [0.5, 0.5]), (None, rows[3][1])]
    frame = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA).repartition(3)
    got = {(r.vec_id, r.component): r for r in whitening.report(frame).collect()}
    want = brute([(i, v) for i, v in rows if v is None or len(v) == 6])
    assert set(got) == set(want)
    for key, (n, dev, w, ex) in want.items():
        r = got[key]
        assert r.n == n and r.deviation == dev
        assert abs(abs(r.whitened) - abs(w)) < 1e-9
        assert abs(r.explained - ex) <= 1e-4 * ex
        assert r.identity_error <= 1e-4
    # one sign per component for all rows
    for j in range(1, 5):
        ratios = {np.sign(got[(i, j)].whitened) * np.sign(want[(i, j)][2]) for i, _ in rows[:120] if abs(want[(i, j)][2]) > 1e-6}
        assert len(ratios) == 1


def test_whitening_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.report(empty).count() == 0
    same = spark.createDataFrame([(i, [0.25, 0.5], "a", "b", "c") for i in range(5)], SCHEMA)
    assert whitening.report(same).count() == 0  # one distinct vector: no component
    nulls = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert whitening.report(nulls).count() == 0


def test_dqds_and_twisted_vectors():
    rng = np.random.default_rng(5)
    for m, d in ((40, 8), (5, 8), (200, 30)):
        a = rng.normal(size=(m, d))
        r = np.linalg.qr(a, mode="r")
        r = np.pad(r, ((0, d - len(r)), (0, 0)))
        diag, sup, w = whitening.bidiagonalise(r)
        lams = whitening.dqds(list(diag**2), list(sup**2))
        ev = np.linalg.eigvalsh(a.T @ a)[::-1]
        top = ev[0]
        assert np.allclose(lams, ev, rtol=1e-10, atol=1e-12 * top)
        for k in range(min(4, m)):
            v = w @ whitening.twisted_vector(diag, sup, lams[k])
            assert np.linalg.norm(a.T @ a @ v - lams[k] * v) <= 1e-9 * top
