"""The regression job: OBT → analytic read → clean → one-hot → time split → scale → fit,
grid search, compare, refit on train+val, test scores, diagnostics, coefficients.

Every step is a DataFrame transformation; the frames used by several fits are persisted
(``MEMORY_AND_DISK``: a lost executor's blocks are recomputed from the short lineage).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.operators import evaluation as ev
from tripdeck.operators import features as fe
from tripdeck.operators import gram
from tripdeck.operators import models as md
from tripdeck.sources.files import ANALYTIC_COLUMNS


@dataclass
class Prepared:
    split_df: DataFrame          # split label, y, raw feature columns (one-hot done)
    scaled: DataFrame            # split label, y, scaled feature columns
    features: list[str]
    levels: dict[str, list[str]]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)
    cached: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        """Release the persisted cleaned input (results already computed stay valid)."""
        for df in self.cached:
            df.unpersist()
        self.cached.clear()

    def __enter__(self) -> "Prepared":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def frame(self, *splits: str) -> DataFrame:
        """Assembled rows (``features`` vector, ``y``) of the given splits."""
        df = self.scaled.where(F.col("split").isin(list(splits)))
        return md.assemble(df, self.features).select("split", "y", "features")


def cleaned(obt: DataFrame, years: fe.SplitYears, sample_fraction: float | None = None,
            extra_columns: tuple[str, ...] = ()) -> DataFrame:
    """Analytic read over the split's year span (optionally hash-sampled) and range cleaning;
    ``extra_columns`` widens the read (e.g. the exported model's fare and tip inputs)."""
    df = obt.where(F.col("source_year").between(*years.span))
    if sample_fraction is not None and sample_fraction < 1.0:
        df = fe.hash_sample(df, sample_fraction)
    cols = list(dict.fromkeys(list(ANALYTIC_COLUMNS) + list(extra_columns)))
    return fe.clean_ranges(df.select(*cols))


def encoded_split(clean: DataFrame, years: fe.SplitYears, poly: bool = False,
                  numeric: tuple[str, ...] = fe.NUMERIC_FEATURES,
                  terms: dict[str, tuple[str, str]] | None = None
                  ) -> tuple[DataFrame, list[str], dict[str, list[str]]]:
    levels = fe.category_levels(clean)
    df = fe.temporal_split(fe.one_hot(clean, levels), years)
    feats = list(numeric)
    if poly:
        terms = terms or fe.POLY_TERMS
        df = fe.poly_features(df, terms)
        feats += list(terms)
    feats += fe.one_hot_columns(levels)
    df = df.withColumnRenamed(fe.TARGET, "y").select(
        "split", F.col("y").cast("double").alias("y"), *[F.col(f).cast("double") for f in feats])
    return df, feats, levels


def prepare(obt: DataFrame, years: fe.SplitYears, poly: bool = False,
            sample_fraction: float | None = None, train_rows: int | None = None,
            wide: bool = False, persist: bool = False) -> Prepared:
    """Features ready for fitting. ``wide`` selects the exported model's inputs and terms.

    With ``persist`` the cleaned analytic rows (10–14 narrow columns) are kept
    (``MEMORY_AND_DISK``) for the passes that follow — category levels, scaler moments, Gram
    moments, fits, scores — so the OBT is read once; ``close()`` releases them."""
    numeric = fe.WIDE_NUMERIC if wide else fe.NUMERIC_FEATURES
    terms = fe.WIDE_POLY_TERMS if wide else fe.POLY_TERMS
    clean = cleaned(obt, years, sample_fraction, extra_columns=tuple(numeric))
    cached = []
    if persist:
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(clean)
    split_df, feats, levels = encoded_split(clean, years, poly, numeric, terms)
    if train_rows is not None:
        train = fe.fixed_sample(split_df.where(F.col("split") == "train"), train_rows)
        split_df = train.unionByName(split_df.where(F.col("split") != "train"))
    stats = fe.scaler_stats(split_df.where(F.col("split") == "train"), feats)
    scaled = fe.apply_scaler(split_df, stats)
    return Prepared(split_df, scaled, feats, levels, stats, cached)


def fit_setting(spark: SparkSession, prep: Prepared, setting: md.Setting,
                objective: str = "reference") -> DataFrame:
    """One setting fitted on train, scored on train and validation."""
    return md.grid_search(spark, prep.frame("train"), prep.frame("val"), [setting], objective)


def grid(spark: SparkSession, prep: Prepared, settings: list[md.Setting] | None = None,
         objective: str = "reference", model_type: str = "moments") -> DataFrame:
    """The grid solved from one pass of Gram moments (plus one pass for MAE)."""
    return md.moment_grid_search(spark, prep.scaled, prep.features,
                                 settings or md.reference_grid(), objective, model_type)


def grid_spark_ml(spark: SparkSession, prep: Prepared, settings: list[md.Setting] | None = None,
                  objective: str = "reference", model_type: str = "spark-ml") -> DataFrame:
    """The same grid with one Spark ML fit per setting."""
    return md.grid_search(spark, prep.frame("train"), prep.frame("val"),
                          settings or md.reference_grid(), objective, model_type)


# The settings the reference carries forward from its grids.
BEST_REFERENCE = (md.Setting("linear", 0.0), md.Setting("ridge", 5e-4),
                  md.Setting("lasso", 1e-4, 1.0), md.Setting("elasticnet", 1e-3, 0.9))


def comparison(spark: SparkSession, prep: Prepared) -> DataFrame:
    """Two implementations side by side — Spark ML fits and the moment solver — for the
    reference-objective winners and the library-objective settings, in one ranked table."""
    library = [md.Setting(k, a, r) for k, a, r in md.LIBRARY_SETTINGS]
    parts = [md.grid_searches(spark, prep.frame("train"), prep.frame("val"),
                              [(list(BEST_REFERENCE), "reference", "spark-ml/reference"),
                               (library, "library", "spark-ml/library")]),
             grid(spark, prep, list(BEST_REFERENCE), "reference", "moments/reference"),
             grid(spark, prep, library, "library", "moments/library")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return ev.leaderboard(out, tie_break=("model", "alpha", "l1_ratio", "type"))


# What the reference refits on train ∪ validation, and its polynomial models; each
# setting with the objective it is fitted by.
REFITTED = (*((s, "reference") for s in BEST_REFERENCE),
            (md.Setting("elasticnet", 1e-4, 0.5), "library"))
POLY_SETTINGS = (md.Setting("linear"), md.Setting("ridge", 1e-4), md.Setting("lasso", 1e-4, 1.0),
                 md.Setting("elasticnet", 1e-4, 0.5))
POLY_MODELS = tuple((s, o) for o in ("reference", "library") for s in POLY_SETTINGS)


def fit_and_test(spark: SparkSession, prep: Prepared, models=REFITTED,
                 splits: tuple[str, ...] = ("train", "val"), scored: tuple[str, ...] = ("test",)
                 ) -> DataFrame:
    """Fit each (setting, objective) on the given splits and score it on the splits ``scored``:
    one pass for each fit's Gram matrix, one pass for the scores of all; best rmse on the last
    scored split first. Columns rmse_/mae_/r2_/n_<split> for each scored split."""
    fitted_on = prep.frame(*splits).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sigma_y, n = md.label_moments(fitted_on)
        fits = [md.fit(fitted_on, s, sigma_y, n, objective) for s, objective in models]
        scores = md.score_models([m for m, _ in fits], {s: prep.frame(s) for s in scored})
        rows = [(s.kind, objective, float(s.alpha), s.l1_ratio,
                 *[v for p in scored for v in (m[f"rmse_{p}"], m[f"mae_{p}"], m[f"r2_{p}"],
                                               int(m[f"n_{p}"]))], secs)
                for (s, objective), m, (_, secs) in zip(models, scores, fits, strict=True)]
        columns = ", ".join(f"rmse_{p} double, mae_{p} double, r2_{p} double, n_{p} bigint"
                            for p in scored)
        return spark.createDataFrame(
            rows, f"model string, type string, alpha double, l1_ratio double, {columns}, "
                  "time_sec double"
        ).orderBy(f"rmse_{scored[-1]}", "type", "model")
    finally:
        fitted_on.unpersist()


def histories(spark: SparkSession, prep: Prepared, settings: list[md.Setting],
              objective: str = "reference") -> DataFrame:
    """Train and validation loss of every iterate of the given fits."""
    rows = gram.rows_of(prep.scaled.where(F.col("split").isin("train", "val")),
                        gram.feature_array(prep.features), "y", F.col("split"))
    return md.loss_history(spark, rows, settings, objective).orderBy(
        "model", "alpha", "l1_ratio", "iteration")


def winner_predictions(spark: SparkSession, prep: Prepared,
                       setting: md.Setting = md.Setting("elasticnet", 1e-4, 0.5),
                       objective: str = "library") -> DataFrame:
    """Test-split predictions of the diagnosed winner (refit on train ∪ validation)."""
    trainval = prep.frame("train", "val")
    sigma_y, n = md.label_moments(trainval)
    model, _ = md.fit(trainval, setting, sigma_y, n, objective)
    return md.predict(model, prep.frame("test")).select("y", "prediction")
