"""Metrics, residual diagnostics and leaderboards against NumPy / pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripdeck.operators import evaluation as ev


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(5)
    y = rng.uniform(0, 250, 3000)
    p = y + rng.normal(0, 8, 3000)
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)],
                                 "y double, prediction double"), y, p


def test_metrics(preds):
    df, y, p = preds
    m = ev.regression_metrics(df).first()
    assert m["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert m["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert m["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_residual_summary(preds):
    df, y, p = preds
    r = y - p
    s = ev.residual_summary(df)
    assert s["std"] == pytest.approx(r.std())
    assert s["p5"] == pytest.approx(np.percentile(r, 5))
    assert s["p95"] == pytest.approx(np.percentile(r, 95))
    assert (s["min"], s["max"]) == (pytest.approx(r.min()), pytest.approx(r.max()))


def test_histogram_matches_numpy(preds):
    df, y, p = preds
    h = ev.residual_histogram(df).orderBy("bin").toPandas()
    counts, _ = np.histogram(y - p, bins=60)
    assert len(h) == 60 and h["count"].sum() == 3000
    assert np.abs(h["count"].to_numpy() - counts).sum() <= 2   # edge rounding only


def test_buckets_match_pandas_cut(preds):
    df, y, p = preds
    got = ev.error_by_bucket(df).orderBy("bucket_order").toPandas()
    cut = pd.cut(y, bins=list(ev.FARE_BUCKET_EDGES), labels=list(ev.FARE_BUCKET_LABELS))
    exp = pd.Series(1, index=cut).groupby(level=0, observed=False).size()
    assert got["count"].tolist() == exp.tolist()
    cov = ev.bucket_coverage(df).first()
    assert cov["in_buckets"] + cov["outside_buckets"] == cov["rows"] == 3000


def test_leaderboard_ties_and_best(spark):
    res = spark.createDataFrame(
        [("ridge", 0.1, None, 5.0), ("ridge", 0.01, None, 5.0), ("lasso", 0.1, 1.0, 4.0)],
        "model string, alpha double, l1_ratio double, rmse_val double")
    lb = ev.leaderboard(res).orderBy("rank").collect()
    assert [(r["model"], r["alpha"]) for r in lb] == [("lasso", 0.1), ("ridge", 0.01),
                                                      ("ridge", 0.1)]
    best = {r["model"]: r["alpha"] for r in ev.best_setting(res).collect()}
    assert best == {"ridge": 0.01, "lasso": 0.1}
    assert ev.top_settings(res, 2).count() == 2
