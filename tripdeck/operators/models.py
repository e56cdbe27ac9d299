"""Linear models on Spark ML: plain, ridge, lasso, elastic net; grid search, refit, scoring,
coefficient tables — plus a closed-form one-feature ridge grid computed from moments.

Penalty mapping. The pickup-only model minimises
    mean(err²) + α·[ρ‖w‖₁ + (1−ρ)‖w‖²]            (intercept not penalised)
Spark's ``LinearRegression`` with ``standardization=False`` fits on the label scaled by its
population std σ_y with regParam λ/σ_y; back in original units its objective is, up to a factor,
    mean(err²) + 2λe‖w‖₁ + (λ(1−e)/σ_y)‖w‖²
Matching terms gives
    λ = α·((1−ρ)·σ_y + ρ/2),   e = (ρ/2) / ((1−ρ)·σ_y + ρ/2).
Library-style objectives (sum-of-squares ridge, ½-mean lasso / elastic net) map to
    ridge λ = α·σ_y/n, e = 0;  lasso λ = α, e = 1;  elastic net λ = α(ρ + (1−ρ)σ_y), e = αρ/λ.
Solver: plain and ridge fits use Spark's normal-equation path; where its Cholesky step meets a
singular matrix (whole one-hot blocks) and its iterations run out, and for every fit with L1, the
same moments are solved by ``operators.solvers``, which ends with a proven duality gap. Either way
one distributed pass aggregates the (d+1)×(d+1) moments (d = feature count, not rows); no further
pass over the data is made, however many iterations. Only coefficients and metric rows reach the
driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdeck.operators.gram import (Moments, absolute_errors, feature_array, moments_by_key,
                                     rows_of)
from tripdeck.operators.solvers import Quadratic, coordinate_descent, solve_all

KINDS = ("linear", "ridge", "lasso", "elasticnet")

# The grids searched by the reference notebook.
RIDGE_ALPHAS = (0.0, 1e-5, 5e-5, 1e-4, 5e-4, 1e-3)
LASSO_ALPHAS = (1e-5, 5e-5, 1e-4, 5e-4, 1e-3)
ENET_ALPHAS = (1e-5, 5e-5, 1e-4, 5e-4, 1e-3)
ENET_L1_RATIOS = (0.1, 0.5, 0.9)
LIBRARY_SETTINGS = (("linear", 0.0, None), ("ridge", 1e-5, None), ("ridge", 1e-4, None),
                    ("ridge", 1e-3, None), ("lasso", 1e-5, None), ("lasso", 1e-4, None),
                    ("elasticnet", 1e-5, 0.5), ("elasticnet", 1e-4, 0.5))


@dataclass(frozen=True)
class Setting:
    kind: str
    alpha: float = 0.0
    l1_ratio: float | None = None

    @property
    def rho(self) -> float:
        return {"linear": 0.0, "ridge": 0.0, "lasso": 1.0}.get(self.kind, self.l1_ratio or 0.0)

    @property
    def name(self) -> str:
        return self.kind


def reference_grid() -> list[Setting]:
    grid = [Setting("ridge" if a > 0 else "linear", a) for a in RIDGE_ALPHAS]
    grid += [Setting("lasso", a, 1.0) for a in LASSO_ALPHAS]
    grid += [Setting("elasticnet", a, r) for a in ENET_ALPHAS for r in ENET_L1_RATIOS]
    return grid


def spark_params(s: Setting, sigma_y: float, n: int, objective: str = "reference"
                 ) -> tuple[float, float]:
    """(regParam, elasticNetParam) that make Spark minimise the given objective."""
    if s.kind == "linear" or s.alpha == 0.0:
        return 0.0, 0.0
    a, rho = s.alpha, s.rho
    if objective == "reference":
        denom = (1.0 - rho) * sigma_y + rho / 2.0
        return a * denom, (rho / 2.0) / denom
    if objective == "library":
        if s.kind == "ridge":
            return a * sigma_y / n, 0.0
        if s.kind == "lasso":
            return a, 1.0
        lam = a * (rho + (1.0 - rho) * sigma_y)
        return lam, a * rho / lam
    raise ValueError(f"unknown objective {objective!r}")


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out,
                           handleInvalid="error").transform(df)


def label_moments(train: DataFrame, y: str = "y") -> tuple[float, int]:
    row = train.agg(F.stddev_pop(y).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return float(row["s"] or 0.0), int(row["n"])


@dataclass(frozen=True)
class GramModel:
    """A linear model solved from moments, with what ``LinearRegressionModel`` offers here.
    ``gap`` is the proven distance of its objective (reference form) from the minimum."""

    coefficients: DenseVector
    intercept: float
    iterations: int
    gap: float

    def transform(self, df: DataFrame) -> DataFrame:
        x = df.withColumn("_x", vector_to_array("features"))
        return x.withColumn("prediction", F.expr(_prediction_sql(self))).drop("_x")


Model = LinearRegressionModel | GramModel


def frame_moments(train: DataFrame, y: str = "y") -> Moments:
    """The moments of an assembled frame: one pass."""
    return moments_by_key(rows_of(train, vector_to_array("features"), y, F.lit("all")))["all"]


def fit_moments(train: DataFrame, s: Setting, objective: str = "reference", y: str = "y",
                moments: Callable[[], Moments] | None = None) -> GramModel:
    """One setting solved from one pass over an assembled frame, with a proven gap. ``moments``
    may give the frame's moments, so that several settings share that pass."""
    m = moments() if moments else frame_moments(train, y)
    alpha, rho = reference_form(s, m.n, objective)
    w, b, steps, gap = solve_from_moments(m, alpha, rho)
    return GramModel(DenseVector(w), b, steps, gap)


def fit(train: DataFrame, s: Setting, sigma_y: float, n: int, objective: str = "reference",
        y: str = "y", max_iter: int = 500, tol: float = 1e-10,
        moments: Callable[[], Moments] | None = None) -> tuple[Model, float]:
    """Fit one setting on an assembled frame; returns the model and the wall time.

    With L1 the model is solved from the moments of one pass (``fit_moments``). Otherwise Spark
    ML fits from the same kind of pass; where it has to iterate and does not end, the moments
    decide as well."""
    t0 = time.perf_counter()
    if s.alpha > 0.0 and s.rho > 0.0:
        return fit_moments(train, s, objective, y, moments), time.perf_counter() - t0
    reg, enet = spark_params(s, sigma_y, n, objective)
    lr = LinearRegression(featuresCol="features", labelCol=y, predictionCol="prediction",
                          regParam=reg, elasticNetParam=enet, standardization=False,
                          fitIntercept=True, maxIter=max_iter, tol=tol, solver="normal")
    model = lr.fit(train)
    if iterations(model) >= max_iter:
        model = fit_moments(train, s, objective, y, moments)
    return model, time.perf_counter() - t0


def iterations(model: Model) -> int:
    return int(model.iterations if isinstance(model, GramModel)
               else model.summary.totalIterations)


def predict(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def scores(model: Model, frames: dict[str, DataFrame], y: str = "y") -> dict:
    """rmse/mae/r2/n of one model per named frame (one pass over all frames)."""
    return score_models([model], frames, y)[0]


def penalty(model: Model, s: Setting) -> float:
    w = model.coefficients.toArray()
    return s.alpha * (s.rho * float(abs(w).sum()) + (1.0 - s.rho) * float((w * w).sum()))


RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("alpha", T.DoubleType()), T.StructField("l1_ratio", T.DoubleType()),
    T.StructField("rmse_train", T.DoubleType()), T.StructField("rmse_val", T.DoubleType()),
    T.StructField("mae_train", T.DoubleType()), T.StructField("mae_val", T.DoubleType()),
    T.StructField("r2_train", T.DoubleType()), T.StructField("r2_val", T.DoubleType()),
    T.StructField("loss_train", T.DoubleType()), T.StructField("loss_val", T.DoubleType()),
    T.StructField("iterations", T.IntegerType()), T.StructField("time_sec", T.DoubleType()),
])


def _prediction_sql(model: Model, arr: str = "_x") -> str:
    """``b + Σ w_j·x[j]`` as SQL text with exact double constants (one JVM call to build)."""
    terms = [f"CAST('{float(model.intercept)!r}' AS DOUBLE)"]
    terms += [f"CAST('{float(w)!r}' AS DOUBLE) * {arr}[{j}]"
              for j, w in enumerate(model.coefficients.toArray()) if w != 0.0]
    return " + ".join(terms)


def score_models(models: list[Model], frames: dict[str, DataFrame],
                 y: str = "y") -> list[dict]:
    """rmse / mae / r2 / n of every model on every named frame in ONE pass over the data.

    Each row's features are turned into an array once; every model's prediction is a linear
    expression over it, and squared / absolute errors are summed per frame name with partial
    aggregation. Result: one dict per model with ``<metric>_<frame>`` keys.
    """
    parts = [df.select(F.lit(name).alias("_frame"), F.col(y).alias("_y"),
                       vector_to_array("features").alias("_x")) for name, df in frames.items()]
    data = parts[0]
    for p in parts[1:]:
        data = data.unionByName(p)
    aggs = [F.count(F.lit(1)).alias("n"), F.var_pop("_y").alias("var_y")]
    for k, m in enumerate(models):
        err = f"(_y - ({_prediction_sql(m)}))"
        aggs += [F.expr(f"sum({err} * {err})").alias(f"sse_{k}"),
                 F.expr(f"sum(abs({err}))").alias(f"sae_{k}")]
    stats = {r["_frame"]: r for r in data.groupBy("_frame").agg(*aggs).collect()}
    out = []
    for k in range(len(models)):
        d = {}
        for name in frames:
            r = stats.get(name)
            n = int(r["n"]) if r else 0
            sse = r[f"sse_{k}"] if r else None
            d[f"rmse_{name}"] = (sse / n) ** 0.5 if n else None
            d[f"mae_{name}"] = r[f"sae_{k}"] / n if n else None
            d[f"r2_{name}"] = (1.0 - sse / (n * r["var_y"])
                               if n and r["var_y"] else None)
            d[f"n_{name}"] = n
        out.append(d)
    return out


def grid_search(spark: SparkSession, train: DataFrame, val: DataFrame, grid: list[Setting],
                objective: str = "reference", model_type: str = "spark", y: str = "y"
                ) -> DataFrame:
    """Fit every setting on ``train`` and score it on ``train`` and ``val``: ``grid_searches``
    of one grid."""
    return grid_searches(spark, train, val, [(grid, objective, model_type)], y)


def grid_searches(spark: SparkSession, train: DataFrame, val: DataFrame,
                  grids: list[tuple[list[Setting], str, str]], y: str = "y") -> DataFrame:
    """Fit every setting of every (grid, objective, model type) on ``train`` and score it on
    ``train`` and ``val``.

    Both frames are persisted once for all grids. Each Spark ML fit is one pass over ``train``
    (the Gram matrix), all settings with L1 share one pass; all settings are then scored together
    in one pass over train ∪ val. The result is one row per setting: metrics, the objective's
    value (MSE + penalty) and the fit time (the shared pass counts for its first setting).
    """
    each = [(s, objective, kind) for grid, objective, kind in grids for s in grid]
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sigma_y, n = label_moments(train, y)
        moments = cache(lambda: frame_moments(train, y))
        fitted = [fit(train, s, sigma_y, n, objective, y, moments=moments)
                  for s, objective, _ in each]
        metrics = score_models([m for m, _ in fitted], {"train": train, "val": val}, y)
        rows = []
        for (s, _, model_type), (model, secs), m in zip(each, fitted, metrics, strict=True):
            pen = penalty(model, s)
            rows.append(Row(
                model=s.kind, type=model_type, alpha=float(s.alpha),
                l1_ratio=None if s.l1_ratio is None else float(s.l1_ratio),
                rmse_train=m["rmse_train"], rmse_val=m["rmse_val"],
                mae_train=m["mae_train"], mae_val=m["mae_val"],
                r2_train=m["r2_train"], r2_val=m["r2_val"],
                loss_train=m["rmse_train"] ** 2 + pen,
                loss_val=None if m["rmse_val"] is None else m["rmse_val"] ** 2 + pen,
                iterations=iterations(model), time_sec=secs))
        return spark.createDataFrame(rows, RESULT_SCHEMA)
    finally:
        train.unpersist()
        val.unpersist()


HISTORY_SCHEMA = ("model string, alpha double, l1_ratio double, iteration int, loss_train double, "
                  "loss_val double, gap double")


def loss_history(spark: SparkSession, rows: DataFrame, settings: list[Setting],
                 objective: str = "reference") -> DataFrame:
    """Loss (MSE + penalty) on train and validation, and the proven gap on train, of every
    iterate of coordinate descent from the zero model, for each setting.

    ``rows`` (key, y, x) has the keys train and val. One pass gives the moments of both splits;
    an iterate is scored on them, so no iteration touches the data."""
    moments = moments_by_key(rows)
    tr, va = moments["train"], moments.get("val")
    q = Quadratic.of(tr)
    out = []
    for s in settings:
        alpha, rho = reference_form(s, tr.n, objective)
        l1, l2 = alpha * rho, alpha * (1.0 - rho)
        trace: list = []
        coordinate_descent(q, l1, l2, trace=trace, polish=False)
        for k, w in trace:
            b = q.intercept(w)
            pen = l1 * float(np.abs(w).sum()) + l2 * float(w @ w)
            losses = [None if m is None else max(sse_from_moments(m, w, b), 0.0) / m.n + pen
                      for m in (tr, va)]
            out.append((s.kind, float(s.alpha), s.l1_ratio, k, *losses, q.gap(w, l1, l2)))
    return spark.createDataFrame(out, HISTORY_SCHEMA)


def coefficient_table(spark: SparkSession, model: Model, features: list[str]
                      ) -> DataFrame:
    """feature, coef, abs_coef ordered by |coef| descending, intercept excluded."""
    w = model.coefficients.toArray().tolist()
    rows = [Row(feature=f, coef=float(c), abs_coef=abs(float(c))) for f, c in zip(features, w)]
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("coef", T.DoubleType()),
                           T.StructField("abs_coef", T.DoubleType())])
    return spark.createDataFrame(rows, schema).orderBy(F.col("abs_coef").desc(), "feature")


# ---------------------------------------------------------------- one-feature ridge from moments

def feature_moments(split_df: DataFrame, features: list[str], y: str = "y",
                    splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Per feature: n, Σx, Σy, Σx², Σxy, Σy² for each split.

    One aggregate over the data with conditional sums (no row is multiplied by the feature
    count); the single result row is then reshaped to one row per feature."""
    yc = F.col(y).cast("double")
    aggs = []
    for s in splits:
        w = F.col("split") == s
        aggs += [F.count(F.when(w, 1)).cast("double").alias(f"n_{s}"),
                 F.sum(F.when(w, yc)).alias(f"sy_{s}"),
                 F.sum(F.when(w, yc * yc)).alias(f"syy_{s}")]
        for k, f in enumerate(features):
            x = F.col(f).cast("double")
            aggs += [F.sum(F.when(w, x)).alias(f"sx_{s}_{k}"),
                     F.sum(F.when(w, x * x)).alias(f"sxx_{s}_{k}"),
                     F.sum(F.when(w, x * yc)).alias(f"sxy_{s}_{k}")]
    row = split_df.agg(*aggs)
    per_feature = []
    for k, f in enumerate(features):
        cols = [F.lit(f).alias("feature")]
        for s in splits:
            cols += [F.col(f"n_{s}"), F.col(f"sx_{s}_{k}").alias(f"sx_{s}"),
                     F.col(f"sy_{s}"), F.col(f"sxx_{s}_{k}").alias(f"sxx_{s}"),
                     F.col(f"sxy_{s}_{k}").alias(f"sxy_{s}"), F.col(f"syy_{s}")]
        per_feature.append(F.struct(*cols))
    return row.select(F.explode(F.array(*per_feature)).alias("m")).select("m.*")


def moment_ridge_grid(moments: DataFrame, alphas: list[float],
                      splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Closed-form ridge on one feature per row, fitted on train for each α:
    b = cov(x, y) / (var(x) + α), a = ȳ − b·x̄ (population moments, intercept unpenalised);
    SSE on any split follows from that split's moments."""
    c = F.col
    n, sx, sy = c("n_train"), c("sx_train"), c("sy_train")
    cov = c("sxy_train") / n - (sx / n) * (sy / n)
    var = c("sxx_train") / n - (sx / n) * (sx / n)
    df = (moments.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
          .withColumn("slope", F.try_divide(cov, var + c("alpha")))
          .withColumn("intercept", sy / n - c("slope") * sx / n))
    out = [F.lit("ridge_1d").alias("model"), "feature", "alpha", "slope", "intercept"]
    a, b = c("intercept"), c("slope")
    for s in splits:
        ns, sxs, sys_ = c(f"n_{s}"), c(f"sx_{s}"), c(f"sy_{s}")
        sse = (c(f"syy_{s}") - 2 * a * sys_ - 2 * b * c(f"sxy_{s}") + ns * a * a
               + 2 * a * b * sxs + b * b * c(f"sxx_{s}"))
        sst = c(f"syy_{s}") - sys_ * sys_ / ns
        out += [F.sqrt(F.try_divide(F.greatest(sse, F.lit(0.0)), ns)).alias(f"rmse_{s}"),
                (F.lit(1.0) - F.try_divide(sse, sst)).alias(f"r2_{s}")]
    return df.select(*out)


# ---------------------------------------------------------------- whole grid from one Gram pass

def gram_by_split(df: DataFrame, features: list[str], y: str = "y", split_col: str = "split"
                  ) -> dict[str, Moments]:
    """The (d+1)² moments per split from one pass; O(d²) numbers per split reach the driver,
    whatever the row count."""
    return moments_by_key(rows_of(df, feature_array(features), y, F.col(split_col)))


def reference_form(s: Setting, n: float, objective: str) -> tuple[float, float]:
    """(α, ρ) of mean(err²) + α[ρ‖w‖₁ + (1−ρ)‖w‖²] equivalent to the setting's objective."""
    if s.kind == "linear" or s.alpha == 0.0:
        return 0.0, 0.0
    if objective == "reference":
        return s.alpha, s.rho
    if s.kind == "ridge":                       # ‖err‖² + α‖w‖²
        return s.alpha / n, 0.0
    if s.kind == "lasso":                       # ½·mean(err²) + α‖w‖₁
        return 2.0 * s.alpha, 1.0
    rho = s.rho                                 # ½·mean(err²) + αρ‖w‖₁ + ½α(1−ρ)‖w‖²
    return s.alpha * (1.0 + rho), 2.0 * rho / (1.0 + rho)


def solve_from_moments(m: Moments, alpha: float, rho: float
                       ) -> tuple[np.ndarray, float, int, float]:
    """(w, b, sweeps, gap) minimising mean(err²) + α[ρ‖w‖₁ + (1−ρ)‖w‖²] (intercept free) on the
    moments, with its proven duality gap; see ``operators.solvers``."""
    q = Quadratic.of(m)
    w, sweeps, gap = solve_all(q, [(alpha * rho, alpha * (1.0 - rho))])[0]
    return w, q.intercept(w), sweeps, gap


def sse_from_moments(m: Moments, w: "np.ndarray", b: float) -> float:
    """Σ(y − b − xᵀw)² expanded over the moments (no pass over the data)."""
    return float(m.syy - 2 * b * m.sy - 2 * w @ m.sxy + m.n * b * b + 2 * b * (w @ m.sx)
                 + w @ m.sxx @ w)


def moment_grid_search(spark: SparkSession, split_df: DataFrame, features: list[str],
                       grid: list[Setting], objective: str = "reference",
                       model_type: str = "moments", y: str = "y") -> DataFrame:
    """The whole grid from two passes over the data, however many settings:

    1. one pass gives the moments of train and validation;
    2. every setting is solved on the d×d train moments (d = feature count): one homotopy path
       for all settings that share an L2 weight, each solution with a proven gap; RMSE / R² /
       loss follow from the moments of each split;
    3. one more pass sums absolute errors of all settings at once (MAE has no moment form).
    """
    frame = split_df.where(F.col("split").isin("train", "val"))
    # features come scaled; the label is centred too, or large means would cancel in the sums
    mean = frame.where("split = 'train'").agg(F.avg(y).alias("m")).first()["m"] or 0.0
    data = rows_of(frame.withColumn(y, F.col(y) - F.lit(mean)), feature_array(features), y,
                   F.col("split"))
    mom = moments_by_key(data)
    tr, va = mom["train"], mom.get("val")
    q = Quadratic.of(tr)
    forms = [reference_form(s, tr.n, objective) for s in grid]
    t0 = time.perf_counter()
    found = solve_all(q, [(a * r, a * (1.0 - r)) for a, r in forms])
    secs = (time.perf_counter() - t0) / max(len(grid), 1)     # a setting's share of the run
    solved = [(s, w, q.intercept(w), sweeps, secs, a, r)
              for s, (w, sweeps, _), (a, r) in zip(grid, found, forms, strict=True)]
    sae = absolute_errors(data, np.column_stack([w for _, w, *_ in solved]),
                          np.array([b for _, _, b, *_ in solved]))
    rows = []
    for k, (s, w, b, sweeps, secs, a, r) in enumerate(solved):
        pen = a * (r * float(np.abs(w).sum()) + (1 - r) * float(w @ w))
        met = {}
        for name, m in (("train", tr), ("val", va)):
            if m is None:
                met[name] = (None, None, None)
                continue
            sse = max(sse_from_moments(m, w, b), 0.0)
            sst = m.syy - m.sy * m.sy / m.n
            met[name] = ((sse / m.n) ** 0.5, float(sae[name][k]) / m.n,
                         1.0 - sse / sst if sst else None)
        rows.append(Row(model=s.kind, type=model_type, alpha=float(s.alpha),
                        l1_ratio=None if s.l1_ratio is None else float(s.l1_ratio),
                        rmse_train=met["train"][0], rmse_val=met["val"][0],
                        mae_train=met["train"][1], mae_val=met["val"][1],
                        r2_train=met["train"][2], r2_val=met["val"][2],
                        loss_train=met["train"][0] ** 2 + pen,
                        loss_val=None if met["val"][0] is None else met["val"][0] ** 2 + pen,
                        iterations=int(sweeps), time_sec=secs))
    return spark.createDataFrame(rows, RESULT_SCHEMA)
