"""Spark ML fits minimise the reference objective: predictions against NumPy solvers."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdeck.operators import models as md


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n, d = 2000, 5
    X = rng.normal(size=(n, d)) * np.array([1.0, 2.0, 0.5, 3.0, 1.0])
    w = np.array([3.0, -2.0, 0.0, 0.5, 0.0])
    y = X @ w + 7.0 + rng.normal(0, 1.5, n)
    schema = T.StructType([T.StructField("features", VectorUDT()),
                           T.StructField("y", T.DoubleType())])
    df = spark.createDataFrame([(Vectors.dense(x), float(t)) for x, t in zip(X, y)],
                               schema).cache()
    return df, X, y


def _reference_solution(X, y, alpha, rho, iters=20000):
    """Proximal gradient on mean(err²) + α(ρ‖w‖₁ + (1−ρ)‖w‖²), intercept unpenalised."""
    Xc, yc = X - X.mean(0), y - y.mean()
    n = len(y)
    L = 2 * np.linalg.eigvalsh(Xc.T @ Xc / n).max() + 2 * alpha * (1 - rho)
    w = np.zeros(X.shape[1])
    for _ in range(iters):
        g = -2 * Xc.T @ (yc - Xc @ w) / n + 2 * alpha * (1 - rho) * w
        z = w - g / L
        w = np.sign(z) * np.maximum(np.abs(z) - alpha * rho / L, 0.0)
    return w, y.mean() - X.mean(0) @ w


@pytest.mark.parametrize("setting", [md.Setting("linear"), md.Setting("ridge", 0.5),
                                     md.Setting("lasso", 0.3, 1.0),
                                     md.Setting("elasticnet", 0.4, 0.5)])
def test_fit_matches_reference_objective(data, setting):
    df, X, y = data
    sigma, n = md.label_moments(df)
    model, secs = md.fit(df, setting, sigma, n, "reference")
    w, b = _reference_solution(X, y, setting.alpha, setting.rho)
    assert np.allclose(model.coefficients.toArray(), w, atol=2e-4)
    assert model.intercept == pytest.approx(b, abs=2e-3)
    assert secs > 0


def test_library_objectives(data):
    df, X, y = data
    sigma, n = md.label_moments(df)
    # ridge on sum of squares: closed form
    alpha = 50.0
    model, _ = md.fit(df, md.Setting("ridge", alpha), sigma, n, "library")
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-4)
    # lasso (1/2n)‖err‖² + α‖w‖₁ is the reference objective with α' = 2α, ρ = 1
    model, _ = md.fit(df, md.Setting("lasso", 0.2, 1.0), sigma, n, "library")
    w, _ = _reference_solution(X, y, 0.4, 1.0)
    assert np.allclose(model.coefficients.toArray(), w, atol=2e-4)


def test_grid_search_rows_and_loss(spark, data):
    df, _, _ = data
    train, val = df.limit(1500), df.subtract(df.limit(1500))
    res = md.grid_search(spark, train, val, [md.Setting("linear"), md.Setting("ridge", 1.0)])
    rows = res.collect()
    assert len(rows) == 2
    lin, ridge = rows
    assert lin["loss_train"] == pytest.approx(lin["rmse_train"] ** 2)
    assert ridge["loss_train"] > ridge["rmse_train"] ** 2


def test_moment_grid_matches_numpy(spark):
    rng = np.random.default_rng(2)
    rows, data = [], {}
    for split, n in (("train", 400), ("val", 200), ("test", 100)):
        x = rng.uniform(0, 10, n)
        y = 2 * x + 1 + rng.normal(0, 1, n)
        data[split] = (x, y)
        rows += [(split, float(a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "split string, x double, y double")
    grid = md.moment_ridge_grid(md.feature_moments(df, ["x"]), [0.0, 2.0]).collect()
    x, y = data["train"]
    for r in grid:
        b = np.cov(x, y, bias=True)[0, 1] / (x.var() + r["alpha"])
        a = y.mean() - b * x.mean()
        xv, yv = data["val"]
        assert r["slope"] == pytest.approx(b)
        assert r["rmse_val"] == pytest.approx(np.sqrt(np.mean((yv - a - b * xv) ** 2)))


def test_batched_scores_equal_transform_scores(spark, data):
    from tripdeck.operators import evaluation as ev
    df, _, _ = data
    sigma, n = md.label_moments(df)
    models = [md.fit(df, s, sigma, n)[0] for s in (md.Setting("linear"),
                                                   md.Setting("lasso", 0.3, 1.0))]
    got = md.score_models(models, {"all": df})
    for m, g in zip(models, got):
        ref = ev.regression_metrics(m.transform(df)).first()
        assert g["rmse_all"] == pytest.approx(ref["rmse"])
        assert g["mae_all"] == pytest.approx(ref["mae"])
        assert g["r2_all"] == pytest.approx(ref["r2"])


def test_moment_grid_equals_spark_ml_grid(spark, data):
    from pyspark.ml.functions import vector_to_array
    df, X, y = data
    split = (df.withColumn("_a", vector_to_array("features"))
             .select("features", "y", *[F.col("_a")[i].alias(f"x{i}") for i in range(5)],
                     F.when(F.rand(3) < 0.7, "train").otherwise("val").alias("split"))
             .cache())
    grid = [md.Setting("linear"), md.Setting("ridge", 0.5), md.Setting("lasso", 0.3, 1.0),
            md.Setting("elasticnet", 0.4, 0.5)]
    feats = [f"x{i}" for i in range(5)]
    ours = md.moment_grid_search(spark, split, feats, grid).collect()
    ml = md.grid_search(spark, split.where("split = 'train'"), split.where("split = 'val'"),
                        grid).collect()
    for a, b in zip(ours, ml):
        for k in ("rmse_train", "rmse_val", "mae_val", "r2_val", "loss_train"):
            assert a[k] == pytest.approx(b[k], rel=1e-6), (a["model"], k)
    lib = md.moment_grid_search(spark, split, feats, [md.Setting("ridge", 50.0)],
                                objective="library").first()
    lib_ml = md.grid_search(spark, split.where("split = 'train'"), split.where("split = 'val'"),
                            [md.Setting("ridge", 50.0)], objective="library").first()
    assert lib["rmse_val"] == pytest.approx(lib_ml["rmse_val"], rel=1e-6)
