"""Solvers on moments: gaps that prove, the path against coordinate descent and proximal steps."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripdeck.operators import gram, models as md, solvers as sv


def moments(X, y):
    z = np.column_stack([np.ones(len(y)), X, y])
    return gram.Moments.of(z.T @ z)


def collinear(seed, n=3000, copies=False):
    """Numbers and two whole, scaled one-hot blocks, as the regression job builds them."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(n, 3))]
    for levels in (2, 7):
        code = rng.choice(levels, n, p=rng.dirichlet(np.ones(levels)))
        parts.append((code[:, None] == np.arange(levels)).astype(float))
    X = np.hstack(parts)
    X = (X - X.mean(0)) / np.where(X.std(0) == 0, 1, X.std(0))
    if copies:
        X = np.column_stack([X, X[:, 0], np.zeros(n)])
    return X, X @ rng.normal(size=X.shape[1]) + 2 * rng.normal(size=n) + 5


def proximal(q, l1, l2, steps=20_000):
    w, m = np.zeros(len(q.c)), np.zeros(len(q.c))
    L, t = 2 * (np.linalg.eigvalsh(q.A).max() + l2), 1.0
    for _ in range(steps):
        z = m - (2 * (q.A @ m - q.c) + 2 * l2 * m) / L
        new = np.sign(z) * np.maximum(np.abs(z) - l1 / L, 0)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        m, w, t = new + (t - 1) / s * (new - w), new, s
    return w


PENALTIES = [(l1, l2) for l1 in (1e-5, 1e-3, 0.3, 3.0) for l2 in (0.0, 1e-6, 1e-3, 0.3)]


def test_without_l1_the_gap_is_the_distance():
    X, y = collinear(9)
    q = sv.Quadratic.of(moments(X, y))
    rng = np.random.default_rng(0)
    for l2 in (0.0, 5e-4, 0.3):
        best = sv.least_squares(q, l2)
        assert q.gap(best, 0.0, l2) <= sv.GAP * q.spread
        w = best + 0.1 * rng.normal(size=len(best))
        assert q.gap(w, 0.0, l2) == pytest.approx(q.loss(w, 0.0, l2) - q.loss(best, 0.0, l2),
                                                  rel=1e-6)
        w, _, gap = sv.coordinate_descent(q, 0.0, l2)
        assert gap <= sv.GAP * q.spread
        trace = []
        sv.coordinate_descent(q, 0.0, l2, trace=trace, polish=False)
        assert 2 < len(trace) < 2000


@pytest.mark.parametrize("copies", [False, True])
def test_every_solution_is_proven_on_collinear_blocks(copies):
    X, y = collinear(1, copies=copies)
    q = sv.Quadratic.of(moments(X, y))
    for l1, l2 in PENALTIES:
        w, sweeps, gap = sv.coordinate_descent(q, l1, l2)
        assert gap <= sv.GAP * q.spread and sweeps < 1000
        assert q.loss(w, l1, l2) <= q.loss(proximal(q, l1, l2, 4000), l1, l2) + 1e-9
        p = sv.path(q, l2, [l1])[l1]
        assert q.gap(p, l1, l2) <= sv.GAP * q.spread
        if l2:      # strictly convex: one solution
            assert np.abs(w - p).max() < 1e-8


def test_one_path_gives_every_l1():
    X, y = collinear(2)
    q = sv.Quadratic.of(moments(X, y))
    for l2 in (0.0, 1e-4, 0.1):
        l1s = [50.0, 2.0, 1.0, 0.1, 1e-2, 1e-4, 0.0]
        found = sv.path(q, l2, l1s)
        assert set(found) == set(l1s) and not found[50.0].any()
        for l1 in l1s[:-1]:
            assert q.gap(found[l1], l1, l2) <= sv.GAP * q.spread


def test_the_gap_bounds_the_distance_from_the_optimum():
    X, y = collinear(3)
    q = sv.Quadratic.of(moments(X, y))
    rng = np.random.default_rng(0)
    for l1, l2 in PENALTIES:
        best = q.loss(sv.coordinate_descent(q, l1, l2)[0], l1, l2)
        for scale in (1e-6, 1e-2, 1.0):
            w = sv.coordinate_descent(q, l1, l2)[0] + scale * rng.normal(size=len(q.c))
            assert q.gap(w, l1, l2) >= q.loss(w, l1, l2) - best - 1e-9


def test_the_whole_grid_equals_single_solutions():
    X, y = collinear(4)
    q = sv.Quadratic.of(moments(X, y))
    pens = [(s.alpha * s.rho, s.alpha * (1 - s.rho)) for s in md.reference_grid()]
    assert len(pens) == 26
    for (l1, l2), (w, _, gap) in zip(pens, sv.solve_all(q, pens), strict=True):
        assert gap <= sv.GAP * q.spread
        if l1 > 0 and l2 > 0:
            assert np.abs(w - sv.coordinate_descent(q, l1, l2)[0]).max() < 1e-8
        elif l1 == 0:
            assert np.abs(q.c - q.A @ w - l2 * w).max() < 1e-9


def test_constant_target_and_constant_features():
    X, y = collinear(5)
    q = sv.Quadratic.of(moments(X, np.full(len(y), 3.0)))
    assert not sv.solve_all(q, [(0.1, 0.0), (0.1, 0.1)])[0][0].any()
    q = sv.Quadratic.of(moments(np.zeros((10, 2)), np.arange(10.0)))
    for w, _, gap in sv.solve_all(q, [(0.1, 0.0), (0.1, 0.1), (0.0, 0.0)]):
        assert not w.any() and gap <= sv.GAP * q.spread


def test_a_limit_that_is_too_small_raises():
    q = sv.Quadratic.of(moments(*collinear(6)))
    with pytest.raises(RuntimeError, match="gap"):
        sv.coordinate_descent(q, 1e-3, 0.0, max_sweeps=1, polish=False)


def test_moments_of_many_one_hot_levels(spark):
    """A thousand levels: the moments equal NumPy's, and ridge and lasso fits are proven."""
    rng = np.random.default_rng(7)
    n, levels = 4000, 1000
    code, x = rng.integers(0, levels, n), rng.normal(size=n)
    split = np.where(rng.random(n) < 0.7, "train", "val")
    y = x + 0.1 * (code % 7) + rng.normal(size=n)
    df = spark.createDataFrame([(str(s), float(a), float(b), int(c)) for s, a, b, c in
                                zip(split, y, x, code, strict=True)],
                               "split string, y double, x double, code int")
    hot = F.transform(F.sequence(F.lit(0), F.lit(levels - 1)),
                      lambda k: (k == F.col("code")).cast("double"))
    got = gram.moments_by_key(gram.rows_of(df, F.concat(F.array("x"), hot), "y", F.col("split")))
    X = np.column_stack([x, code[:, None] == np.arange(levels)]).astype(float)
    for s in ("train", "val"):
        want = moments(X[split == s], y[split == s])
        for a, b in ((got[s].sxx, want.sxx), (got[s].sxy, want.sxy), (got[s].sx, want.sx)):
            assert np.allclose(a, b)
        assert got[s].n == want.n and np.isclose(got[s].syy, want.syy)
    q = sv.Quadratic.of(got["train"])
    (_, _, a), (_, _, b) = sv.solve_all(q, [(0.05, 0.0), (0.0, 0.1)])
    assert a <= sv.GAP * q.spread and b == 0.0


def test_moments_skip_incomplete_rows_and_empty_input(spark):
    kind = "split string, y double, x double"
    rows = [("a", 1.0, 2.0), ("a", None, 2.0), ("a", 1.0, None), (None, 1.0, 1.0), ("b", 0.5, 4.0)]
    got = gram.moments_by_key(gram.rows_of(spark.createDataFrame(rows, kind),
                                           gram.feature_array(["x"]), "y", F.col("split")))
    assert {k: (m.n, m.sxx.item(), m.syy) for k, m in got.items()} == {"a": (1, 4, 1),
                                                                      "b": (1, 16, 0.25)}
    assert gram.moments_by_key(gram.rows_of(spark.createDataFrame([], kind),
                                            gram.feature_array(["x"]), "y",
                                            F.col("split"))) == {}


def test_loss_history_scores_every_iterate_on_both_splits(spark):
    X, y = collinear(8, n=900)
    split = ["train"] * 600 + ["val"] * 300
    df = spark.createDataFrame([(s, float(t), [float(v) for v in x]) for s, t, x in
                                zip(split, y, X, strict=True)],
                               "key string, y double, x array<double>")
    s = md.Setting("elasticnet", 0.1, 0.5)
    rows = md.loss_history(spark, df, [s]).orderBy("iteration").collect()
    q = sv.Quadratic.of(moments(X[:600], y[:600]))
    w = sv.coordinate_descent(q, 0.05, 0.05)[0]
    b, pen = q.intercept(w), 0.05 * np.abs(w).sum() + 0.05 * w @ w
    assert rows[0].loss_train == pytest.approx(y[:600].var())
    assert rows[-1].loss_train == pytest.approx(((y[:600] - b - X[:600] @ w) ** 2).mean() + pen)
    assert rows[-1].loss_val == pytest.approx(((y[600:] - b - X[600:] @ w) ** 2).mean() + pen)
    losses = [r.loss_train for r in rows]
    assert all(b <= a + 1e-12 for a, b in itertools.pairwise(losses)) and len(rows) > 3
    assert rows[-1].gap <= sv.GAP * q.spread < rows[0].gap
