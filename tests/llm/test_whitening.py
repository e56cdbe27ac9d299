import math

import numpy as np
import pytest

from tripdeck.llm.whitening import bidiagonalise, integer_grid, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, id string, n int, whitened int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "s", 3, 4) for i, v in rows], SCHEMA)


def fit(spark, rows, components=32):
    fitted = whitening(integer_grid(table(spark, rows), "vec_id", "embedding", 64, 1_000_000),
                       components)
    return fitted, fitted.rows().collect()


def brute(rows):
    """Kept ids, exact integer vectors, eigenvalues (falling) and eigenvectors by NumPy."""
    kept = [(i, v) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]
                  for _, v in kept], np.int64)
    a = (x * len(x) - x.sum(0)) / len(x)
    values, vectors = np.linalg.eigh(a.T @ a / len(x))
    return [i for i, _ in kept], x, a, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("dims,components", [(12, 5), (12, 32), (40, 32)])
def test_matches_a_dense_eigensolver(spark, dims, components):
    rng = np.random.default_rng(dims)
    mixed = rng.normal(size=(300, dims)) @ rng.normal(size=(dims, dims))
    rows = [(k, v.tolist()) for k, v in enumerate(mixed)]
    rows += [(900, None), (901, [math.nan] * dims), (902, [math.inf] + [0.0] * (dims - 1)),
             (903, [None] * dims), (None, rows[0][1]), (5, rows[6][1]), (7, rows[7][1])]
    fitted, out = fit(spark, rows, components)
    ids, x, a, values, axes = brute(rows)
    k = min(components, dims)
    assert fitted.n == len(x) == len(out) and fitted.axes.shape == (dims, k)
    assert np.allclose(fitted.values, values[:k], rtol=1e-10)
    assert np.allclose(fitted.explained, values[:k] / values.sum(), rtol=1e-10)
    sign = np.sign((fitted.axes * axes[:, :k]).sum(0))
    assert np.abs(fitted.axes * sign - axes[:, :k]).max() < 1e-9
    want = sorted(((i is None, i or 0), int(((x[k] * len(x) - x.sum(0)) ** 2).sum()))
                  for k, i in enumerate(ids))
    assert sorted(((r.id is None, r.id or 0), int(r.deviation)) for r in out) == want
    white = a @ axes[:, :k] / np.sqrt(values[:k]) * sign
    by_id = {i: white[k] for k, i in enumerate(ids) if ids.count(i) == 1}
    for r in out:
        assert r.n == len(x)
        if r.id in by_id:
            assert np.allclose(r.whitened, by_id[r.id], atol=1e-8)
    assert fitted.identity_error() < 1e-10


def test_equal_eigenvalues_and_missing_rank(spark):
    # plus and minus each axis: six equal eigenvalues; two more entries that never change
    rows = [(2 * k + s, [float(8 * (1 - 2 * s) * (j == k)) for j in range(6)] + [0.5, 0.25])
            for k in range(6) for s in (0, 1)]
    fitted, out = fit(spark, rows)
    assert np.allclose(fitted.values, [(512 ** 2) / 6] * 6, rtol=1e-12)
    assert all(len(r.whitened) == 6 for r in out) and fitted.identity_error() < 1e-12


def test_tables_without_variance_or_vectors(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        fitted, out = fit(spark, rows)
        assert fitted.n == 0 and out == [] and fitted.identity_error() is None
    fitted, out = fit(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [1.0])])
    assert fitted.n == 2 and [(r.id, int(r.deviation), r.whitened) for r in out] == [
        (1, 0, []), (2, 0, [])]


def test_deviations_beyond_64_bits(spark):
    rows = spark.createDataFrame([(1, [4_000_000_000]), (2, [-4_000_000_000]), (3, [1])],
                                 "id long, x array<long>")
    got = {r.id: int(r.deviation) for r in whitening(rows).rows().collect()}
    assert got == {1: (12_000_000_000 - 1) ** 2, 2: (12_000_000_000 + 1) ** 2, 3: 4}


def test_bidiagonalisation_settles_early_only_when_nothing_is_left():
    rng = np.random.default_rng(3)
    falling = np.linalg.qr(rng.normal(size=(200, 80)))[0] * 0.5 ** np.arange(80)
    for a in (falling, rng.normal(size=(200, 80))):
        calls = []

        def product(W, w, a=a, calls=calls):
            calls.append(1)
            u = a @ w
            return (a @ W).T @ u, u @ u, a.T @ u
        sigma, right = bidiagonalise(product, 80, 6, (a ** 2).sum())
        assert np.allclose(sigma[:6], np.linalg.svd(a)[1][:6], rtol=1e-10)
        assert np.abs(right.T @ right - np.eye(right.shape[1])).max() < 1e-13
        assert (len(calls) < 40) == (a is falling)
