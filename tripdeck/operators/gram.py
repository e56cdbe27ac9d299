"""Moments of many features in one pass: n, Σx, Σy, Σxxᵀ, Σxy, Σy² per group of rows.

Every task adds up z zᵀ of its Arrow batches, with z = (1, x, y), as one matrix product a batch,
and sends one (d+2)² matrix per group. The matrices are added in two levels: first by as many
tasks as their bytes call for (adaptive execution coalesces the shuffle), then by one. Features
travel as one array column, so the plan does not grow with their number, and neither rows nor
one-hot columns are multiplied. Memory per task is 8 (d+2)² bytes and one batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Sufficient statistics of (x, y) for one group: n, Σx, Σy, Σxxᵀ, Σxy, Σy²."""

    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float

    @classmethod
    def of(cls, zz: np.ndarray) -> Moments:
        return cls(float(zz[0, 0]), zz[0, 1:-1].copy(), float(zz[0, -1]),
                   zz[1:-1, 1:-1].copy(), zz[1:-1, -1].copy(), float(zz[-1, -1]))


def _added(kinds: int):
    """Arrow function that adds up the matrices of each key it sees."""
    def add(batches):
        sums = {}
        for batch in batches:
            for key, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              strict=True):
                own = np.frombuffer(m, np.float64)
                sums[key] = sums[key] + own if key in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()),
                 pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["key", "m"])
    return add


def summed_by_key(rows: DataFrame, part) -> dict[str, np.ndarray]:
    """Sums of ``part(x, y)`` (a flat array) over the batches of ``rows`` (key, y, x), per key."""
    def each(batches):
        sums = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            key, x = batch.column(0), batch.column(2)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            names = key.unique().to_pylist()
            codes = key.dictionary_encode()
            codes = codes.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(names):
                own = slice(None) if len(names) == 1 else codes == k
                got = part(x[own], y[own]).ravel()
                sums[name] = sums[name] + got if name in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()),
                 pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["key", "m"])
    kind = "key string, m binary"
    parts = rows.mapInArrow(each, kind).repartition(F.xxhash64("m"))
    merged = parts.mapInArrow(_added(1), kind).repartition(1).mapInArrow(_added(1), kind)
    return {r["key"]: np.frombuffer(bytes(r["m"]), np.float64) for r in merged.collect()}


def rows_of(df: DataFrame, x: Column, y: str, key: Column) -> DataFrame:
    """(key, y, x) as string, double, array<double>; rows with a null key, y or feature raise
    nothing and count nowhere."""
    rows = df.select(key.cast("string").alias("key"), F.col(y).cast("double").alias("y"),
                     x.cast("array<double>").alias("x"))
    return rows.where("key is not null and y is not null and x is not null "
                      "and not exists(x, v -> v is null)")


def feature_array(features: list[str]) -> Column:
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features])


def moments_by_key(rows: DataFrame) -> dict[str, Moments]:
    """Moments of (key, y, x) rows for each key: one pass."""
    def part(x, y):
        z = np.empty((len(y), x.shape[1] + 2))
        z[:, 0], z[:, 1:-1], z[:, -1] = 1.0, x, y
        return z.T @ z
    out = {}
    for key, flat in summed_by_key(rows, part).items():
        d = int(round(len(flat) ** 0.5))
        out[key] = Moments.of(flat.reshape(d, d))
    return out


def absolute_errors(rows: DataFrame, weights: np.ndarray, intercepts: np.ndarray
                    ) -> dict[str, np.ndarray]:
    """Σ|y − b − xᵀw| per key, for every model (a column of ``weights``) in one pass."""
    def part(x, y):
        return np.abs(y[:, None] - intercepts[None, :] - x @ weights).sum(0)
    return summed_by_key(rows, part)
