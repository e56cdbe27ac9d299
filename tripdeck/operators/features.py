"""Regression features: cleaning, reproducible sampling, time split, one-hot, polynomial
terms, standard scaling.

Everything stays in DataFrames. What reaches the driver is bounded by the feature count:
category levels (checked against ``max_levels``) and one row of scaler moments, which is then
applied as literals inside the projection (whole-stage codegen, no join).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdeck.functions.hashing import HASH_BITS, row_hash
from tripdeck.operators.selection import OrderStatistics
from tripdeck.session import scratch_path

NUMERIC_FEATURES = ("pickup_hour", "pickup_dow", "month", "year", "trip_distance",
                    "passenger_count")
CATEGORICAL_FEATURES = ("service_type", "pu_borough", "do_borough")
TARGET = "total_amount"
# All columns of the analytic read: rows tie on the hash only when they are equal in every
# column (to 1e-6 for doubles), so the tied group at the sample threshold stays small.
SAMPLE_KEY = ("pickup_hour", "pickup_dow", "month", "year", "trip_distance", "passenger_count",
              "service_type", "pu_borough", "do_borough", "total_amount")
OBT_SAMPLE_KEY = ("pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
                  "vendor_id", "rate_code_id", "payment_type", "passenger_count", "service_type")

# The polynomial terms of the pickup-only model.
POLY_TERMS = {
    "trip_distance_sq": ("trip_distance", "trip_distance"),
    "pickup_hour_sq": ("pickup_hour", "pickup_hour"),
    "passenger_count_sq": ("passenger_count", "passenger_count"),
    "trip_dist_x_hour": ("trip_distance", "pickup_hour"),
    "trip_dist_x_pass": ("trip_distance", "passenger_count"),
}

# The wider set of the exported polynomial model (names as published), whose
# inputs include fare and tip parts of the target.
WIDE_NUMERIC = ("fare_amount", "tip_pct", "trip_distance", "trip_duration_min", "avg_speed_mph",
                "year", "month", "pickup_hour", "pickup_dow")
WIDE_POLY_TERMS = {
    "fare_amount^2": ("fare_amount", "fare_amount"),
    "fare_amount*tip_pct": ("fare_amount", "tip_pct"),
    "trip_distance^2": ("trip_distance", "trip_distance"),
    "trip_distance*avg_speed_mph": ("trip_distance", "avg_speed_mph"),
    "tip_pct^2": ("tip_pct", "tip_pct"),
    "trip_distance*fare_amount": ("trip_distance", "fare_amount"),
    "trip_duration_min^2": ("trip_duration_min", "trip_duration_min"),
    "avg_speed_mph^2": ("avg_speed_mph", "avg_speed_mph"),
}


@dataclass(frozen=True)
class SplitYears:
    """Time split: train, validation and test year ranges (inclusive)."""

    train: tuple[int, int] = (2018, 2020)
    val: tuple[int, int] = (2021, 2021)
    test: tuple[int, int] = (2022, 2023)

    @property
    def span(self) -> tuple[int, int]:
        return self.train[0], self.test[1]


REFERENCE_SPLIT = SplitYears()
TESTDATA_SPLIT = SplitYears(train=(1995, 1997), val=(1998, 1998), test=(1999, 2001))


# ---------------------------------------------------------------- filters and samples

def clean_ranges(df: DataFrame) -> DataFrame:
    """Strict ranges 0<distance<100, 0<passengers<7, 0<total<500, then drop rows holding any
    NULL or NaN."""
    return (df.where((F.col("trip_distance") > 0) & (F.col("trip_distance") < 100)
                     & (F.col("passenger_count") > 0) & (F.col("passenger_count") < 7)
                     & (F.col(TARGET) > 0) & (F.col(TARGET) < 500))
              .na.drop(how="any"))


def hash_threshold(fraction: float) -> int:
    return int(fraction * (2 ** HASH_BITS))


def hash_sample(df: DataFrame, fraction: float, seed: int = 42,
                key_cols: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Bernoulli sample by hash threshold: row kept iff hash(seed, key) < fraction · 2^60.
    Reproducible, engine-independent, and a pure filter (no shuffle)."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    keys = list(key_cols or [c for c in OBT_SAMPLE_KEY if c in df.columns])
    return df.where(row_hash(df.schema, keys, seed) < F.lit(hash_threshold(fraction)))


def smallest_per_task(df: DataFrame, column: str, n: int) -> DataFrame:
    """Of each task's rows the ``n`` smallest by (``column``, all other columns in order): a
    bounded selection while the batches pass, so a task holds some multiple of ``n`` rows."""
    names = [c for c in df.columns if c != column]

    def smallest(batches):
        table = pa.Table.from_batches(batches)
        h = table[column].to_numpy()
        if len(h) <= n:
            return batches
        bound = np.partition(h, n - 1)[n - 1]
        below, tied = np.flatnonzero(h < bound), np.flatnonzero(h == bound)
        if len(below) + len(tied) > n:     # sorted only where equal hashes reach over the bound
            ties = table.take(tied)
            order = pc.sort_indices(ties, sort_keys=[(c, "ascending") for c in names],
                                    null_placement="at_start").to_numpy()
            tied = tied[order[:n - len(below)]]
        return table.take(np.concatenate((below, tied))).combine_chunks().to_batches()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > 3 * n + 10_000:
                held = smallest(held)
                rows = sum(b.num_rows for b in held)
        if held:
            yield from smallest(held)
    return df.mapInArrow(run, df.schema)


def fixed_sample(df: DataFrame, n: int, seed: int = 42,
                 key_cols: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the n smallest by (hash, all columns).

    ``df`` is read once: every task passes on its n smallest rows, which are written to scratch
    space (their number is bounded by n for each task and, once tasks hold more than n rows, far
    below the table's). The n-th smallest hash of all is found among them by distributed
    selection; rows under it pass a filter, and only rows tied at it go through an ordered take.
    """
    if n <= 0:
        return df.limit(0)
    keys = list(key_cols or SAMPLE_KEY)
    hashed = df.withColumn("_h", row_hash(df.schema, keys, seed))
    path = scratch_path(df.sparkSession, "sample-candidates")
    smallest_per_task(hashed, "_h", n).write.parquet(path)
    some = df.sparkSession.read.schema(hashed.schema).parquet(path)
    with OrderStatistics(some, "_h", keep=False) as st:
        if n >= st.n:
            return some.drop("_h")
        t = st.values_at([n - 1])[n - 1]
        m = n - st.count_below(t)
    below = some.where(F.col("_h") < F.lit(t))
    tied = some.where(F.col("_h") == F.lit(t)).orderBy(*df.columns).limit(m)
    return below.unionByName(tied).drop("_h")


def split_label(years: SplitYears, year_col: str = "year") -> Column:
    y = F.col(year_col)
    return (F.when(y.between(*years.train), F.lit("train"))
             .when(y.between(*years.val), F.lit("val"))
             .when(y.between(*years.test), F.lit("test")))


def temporal_split(df: DataFrame, years: SplitYears, year_col: str = "year") -> DataFrame:
    """Rows labelled train / val / test by year; rows outside all ranges are left out."""
    return df.withColumn("split", split_label(years, year_col)).where(F.col("split").isNotNull())


def split_counts(split_df: DataFrame) -> DataFrame:
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- encoding

def category_levels(df: DataFrame, cols=CATEGORICAL_FEATURES, max_levels: int = 1000
                    ) -> dict[str, list[str]]:
    """Sorted distinct levels per categorical column, from the whole frame given (one job)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("level")) for c in cols
    ])).alias("kv")).select("kv.col", "kv.level").where(F.col("level").isNotNull()).distinct()
    rows = stacked.limit(max_levels * len(cols) + 1).collect()
    if len(rows) > max_levels * len(cols):
        raise ValueError("too many category levels for one-hot encoding")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["col"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_columns(levels: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{lvl}" for c, lv in levels.items() for lvl in lv]


def one_hot(df: DataFrame, levels: dict[str, list[str]], drop_source: bool = True) -> DataFrame:
    """One 0/1 column per level, every level kept (no level dropped)."""
    cols = {f"{c}_{lvl}": (F.col(c) == F.lit(lvl)).cast("int")
            for c, lv in levels.items() for lvl in lv}
    out = df.withColumns(cols)
    return out.drop(*levels.keys()) if drop_source else out


def poly_features(df: DataFrame, terms: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Squares and pairwise products as extra columns."""
    terms = terms or POLY_TERMS
    return df.withColumns({name: F.col(a).cast("double") * F.col(b).cast("double")
                           for name, (a, b) in terms.items()})


# ---------------------------------------------------------------- scaling

def scaler_stats(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per feature (one aggregate row); a zero std becomes 1."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m_{f}"),
                 F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}")]
    row = df.agg(*aggs).first()
    out = {}
    for f in features:
        m, s = row[f"m_{f}"], row[f"s_{f}"]
        out[f] = (m, 1.0 if (s is None or s == 0.0) else s)
    return out


def scaler_stats_frame(df: DataFrame, features: list[str]) -> DataFrame:
    """The same moments as a long frame ``feature, mean, std`` (one aggregate row over the
    data, reshaped after aggregation — the data itself is never multiplied by d)."""
    stats = scaler_stats(df, features)
    return df.sparkSession.createDataFrame(
        [(f, m, s) for f, (m, s) in stats.items()], "feature string, mean double, std double")


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x − mean) / std with the train moments, for any split."""
    return df.withColumns({f: (F.col(f).cast("double") - F.lit(m)) / F.lit(s)
                           for f, (m, s) in stats.items()})
