"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from shopgrain.llm import whiten
from shopgrain.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def dense(vectors, components=4):
    """From (id, vector) pairs: {(id, component): (deviation, |whitened|, explained)} and n."""
    kept = [
        (i, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v in vectors
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in kept}))
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        white = (x - total / n) @ basis / np.sqrt(np.where(values > 0, values, 1))
        dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total))
        out += [(i, k + 1, n, dev, white[k], values[k] / np.trace(centred.T @ centred / n)) for k in range(len(values))]
    return out


def check(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], abs(r[4]))
    got = sorted((tuple(r)[:6] for r in got), key=key)
    want = sorted(want, key=key)
    sign = {}
    for g, w in zip(got, want):
        assert (g[0], g[1], g[2], g[3]) == (w[0], w[1], w[2], w[3])
        if abs(w[4]) > 1e-6:
            sign.setdefault(g[1], np.sign(g[4] * w[4]))
            assert g[4] * sign[g[1]] == pytest.approx(w[4], rel=1e-6, abs=1e-8)
        assert g[5] == pytest.approx(w[5], rel=1e-9)


def test_op12(spark):
    rows = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(rows, dense([(r["vec_id"], r["embedding"]) for r in given]))
    assert rows[0]["identity_error"] < 1e-9


def made(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, x int")


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    fine = [(i, [float(np.float32(c)) for c in rng.normal(0, 3, 6)], "a", 1) for i in range(300)]
    odd = [
        (400, None, "a", 1), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a", 1), (402, [float("nan")] * 6, "a", 1),
        (403, [float("inf")] * 6, "a", 1), (404, [], "a", 1), (405, [1.0], "a", 1), (None, fine[0][1], "a", 1),
        (7, fine[7][1], "a", 1), (406, [-0.0] * 6, "a", 1), (406, [0.0] * 6, "a", 1),
    ]
    got = whiten.whiten(made(spark, fine + odd)).collect()
    check(got, dense([r[:2] for r in fine + odd if r[1] is None or len(r[1]) == 6]))


def test_few_vectors(spark):
    assert whiten.whiten(made(spark, [(1, [1.0, 2.0], "a", 1)])).collect() == []
    assert whiten.whiten(made(spark, [])).collect() == []
    one = whiten.whiten(made(spark, [(1, [1.0, 2.0], "a", 1), (2, [3.0, 2.5], "a", 1)])).collect()
    assert [(r["id"], r["component"], abs(r["whitened"])) for r in one] == [
        (1, 1, pytest.approx(1.0)), (2, 1, pytest.approx(1.0))
    ]
    huge = [(i, [1e30 * (i == 3), 3e13 * i, 1.0], "a", 1) for i in range(5)]
    assert {r["deviation"] for r in whiten.whiten(made(spark, huge)).collect()} == {None}


@pytest.mark.parametrize("dims,gap", [(5, 0.5), (40, 0.01), (40, 1e-6)])
def test_pairs_to_double_precision(dims, gap):
    """Close and repeated eigenvalues: residuals at rounding, eigenvalues as by a dense solver."""
    rng = np.random.default_rng(dims)
    basis = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    values = np.array([9.0, 9.0 - gap, 9.0 - gap, 7.0] + [6.9 / (1 + i) for i in range(dims - 4)])
    a = (basis * values) @ basis.T

    class Dense:
        dims = len(values)

        def __call__(self, u):
            return a @ u

    found, vectors = whiten.eigenpairs(Dense(), 4, values.sum())
    assert found == pytest.approx(values[:4], rel=1e-12)
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-13 * 9
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-13
