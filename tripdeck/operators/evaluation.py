"""Scores and diagnostics of a predictor: RMSE / MAE / R², residual summary and histogram,
error by fare bucket, residual points, leaderboards.

All metrics are aggregates over prediction frames (partial aggregation on the executors);
R² uses the split's own mean (SS_tot = n · var_pop(y)). Percentiles are exact and distributed
(:mod:`tripdeck.operators.selection`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripdeck.operators.selection import OrderStatistics

# Fare buckets (right-closed) and their labels.
FARE_BUCKET_EDGES = (0, 10, 20, 30, 40, 60, 100, 200)
FARE_BUCKET_LABELS = ("0–10", "10–20", "20–30", "30–40", "40–60", "60–100", "100–200")
HISTOGRAM_BINS = 60


def _err(y: str, pred: str):
    return F.col(y) - F.col(pred)


def metric_columns(y: str = "y", pred: str = "prediction", suffix: str = "") -> list:
    e = _err(y, pred)
    return [F.sqrt(F.avg(e * e)).alias(f"rmse{suffix}"),
            F.avg(F.abs(e)).alias(f"mae{suffix}"),
            (F.lit(1.0) - F.sum(e * e) / (F.count(F.lit(1)) * F.var_pop(y))).alias(f"r2{suffix}"),
            F.count(F.lit(1)).alias(f"n{suffix}")]


def regression_metrics(pred_df: DataFrame, y: str = "y", pred: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """rmse, mae, r2, n (per group when ``by`` is given)."""
    cols = metric_columns(y, pred)
    return pred_df.groupBy(*(by or [])).agg(*cols)


def residuals(pred_df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    return pred_df.select(F.col(y).alias("y_true"), _err(y, pred).alias("residual"))


def residual_summary(pred_df: DataFrame, y: str = "y", pred: str = "prediction") -> dict:
    """mean, population std, p5, p95 (linear interpolation), min, max of y − prediction."""
    with OrderStatistics(residuals(pred_df, y, pred), "residual") as st:
        pct = st.percentiles([0.05, 0.95])
        return {"mean": st.mean, "std": st.std, "p5": pct[0.05], "p95": pct[0.95],
                "min": st.lo, "max": st.hi}


def residual_histogram(pred_df: DataFrame, y: str = "y", pred: str = "prediction",
                       bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max] of the residuals; the maximum goes into the last bin.
    All ``bins`` bins are reported, empty ones with count 0."""
    r = residuals(pred_df, y, pred)
    mm = r.agg(F.min("residual").alias("lo"), F.max("residual").alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    spark = pred_df.sparkSession
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return all_bins.select("bin", F.lit(None).cast("double").alias("lower"),
                               F.lit(None).cast("double").alias("upper"),
                               F.lit(0).cast("bigint").alias("count"))
    width = (hi - lo) if hi > lo else 1.0
    b = F.least(F.floor(F.lit(float(bins)) * (F.col("residual") - F.lit(lo)) / F.lit(width))
                + 1, F.lit(bins)).cast("int")
    # at most ``bins`` rows: a proven bound, so broadcast
    counts = F.broadcast(r.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    return (all_bins.join(counts, "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.lit(width) * (F.col("bin") - 1) / F.lit(float(bins)))
                    .alias("lower"),
                    (F.lit(lo) + F.lit(width) * F.col("bin") / F.lit(float(bins))).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def fare_bucket(col: str = "y_true"):
    """Right-closed buckets (0,10], (10,20], ... (100,200]; outside → NULL."""
    c = F.col(col)
    expr = None
    for lo, hi, label in zip(FARE_BUCKET_EDGES[:-1], FARE_BUCKET_EDGES[1:], FARE_BUCKET_LABELS):
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def error_by_bucket(pred_df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    """rmse, mae, count per fare bucket of the true value; every bucket listed (empty ones with
    count 0). Rows outside all buckets are not in the table: see ``bucket_coverage``."""
    r = residuals(pred_df, y, pred).withColumn("bucket", fare_bucket())
    stats = (r.where(F.col("bucket").isNotNull()).groupBy("bucket")
             .agg(F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
                  F.avg(F.abs("residual")).alias("mae"),
                  F.count(F.lit(1)).alias("count")))
    labels = pred_df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("bucket_order"), F.lit(lbl).alias("bucket"))
        for i, lbl in enumerate(FARE_BUCKET_LABELS)])).alias("b")).select("b.*")
    # one row per bucket label at most: broadcast
    return (labels.join(F.broadcast(stats), "bucket", "left")
            .select("bucket_order", "bucket", "rmse", "mae",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def bucket_coverage(pred_df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    r = residuals(pred_df, y, pred).withColumn("bucket", fare_bucket())
    return r.agg(F.count(F.lit(1)).alias("rows"),
                 F.count("bucket").alias("in_buckets"),
                 F.count(F.when(F.col("bucket").isNull(), 1)).alias("outside_buckets"))


def leaderboard(results: DataFrame, by: str = "rmse_val",
                tie_break: tuple[str, ...] = ("model", "alpha", "l1_ratio")) -> DataFrame:
    """Results ranked by ``by`` (ascending) with an explicit tie-break. The window has no
    partition: results are one row per model setting, never data rows."""
    order = [F.col(by).asc_nulls_last()] + [F.col(c).asc_nulls_first()
                                            for c in tie_break if c in results.columns]
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_settings(results: DataFrame, k: int = 10, by: str = "rmse_val",
                 tie_break: tuple[str, ...] = ("model", "alpha", "l1_ratio")) -> DataFrame:
    return leaderboard(results, by, tie_break).where(F.col("rank") <= k)


def best_setting(results: DataFrame, family: str = "model", by: str = "rmse_val",
                 setting: tuple[str, ...] = ("alpha", "l1_ratio")) -> DataFrame:
    """Per family, the setting with the lowest ``by`` (ties: smallest setting)."""
    cols = [c for c in setting if c in results.columns]
    key = F.struct(F.col(by), *[F.col(c) for c in cols])
    best = results.groupBy(family).agg(F.min(key).alias("best"))
    return best.select(family, *[F.col(f"best.{c}").alias(c) for c in [by] + cols])
