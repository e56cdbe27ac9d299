"""Exact order statistics without gathering a column into one task.

A column is scanned at most twice, whatever its size and however many ranks are asked for.

1. One aggregate takes count, bounds, mean, deviation and a mergeable KLL quantile sketch (a few
   kilobytes a task, merged like any aggregate).
2. For each rank the sketch brackets the value between two quantiles, with several times the
   sketch's rank error on either side. The second scan counts what lies below and between the
   brackets and, per distinct value, what lies inside them, all in one grouped count with partial
   aggregation, so ties cost one row. Cumulated from below, these counts give the values exactly.

If a bracket holds more than ``final_rows`` distinct values, its counted values (not the column)
are narrowed further by ranges of equal width. Should a bracket miss its rank, which the sketch
allows with a small probability, the counts show it and the gap that holds it is searched.

Used for exact percentiles (residual summary) and for the fixed-size hash sample, where the
n-th smallest hash is the sample threshold.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BINS = 1024
DEFAULT_FINAL_ROWS = 20_000
SKETCH_K = 2048
# Normalised rank error of a KLL sketch of this k with 99 % confidence, from its published
# analysis; brackets take this multiple of it on either side.
RANK_ERROR = 2.296 / SKETCH_K ** 0.9021
BRACKET = 3.0


def _is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


class OrderStatistics:
    """A numeric column with n / min / max / mean / population std from one scan; exact order
    statistics take one more. ``keep`` persists the projected column between the two, so that an
    expensive upstream plan runs once."""

    def __init__(self, df: DataFrame, col: str, bins: int = DEFAULT_BINS,
                 final_rows: int = DEFAULT_FINAL_ROWS, keep: bool = True):
        self.integral = _is_integral(df.schema[col].dataType)
        x = df.select(F.col(col).alias("x")).where(F.col("x").isNotNull())
        if self.integral:
            x = x.select(F.col("x").cast("long").alias("x"))
        else:
            x = x.select(F.col("x").cast("double").alias("x")).where(~F.isnan("x"))
        self.x = x.persist(StorageLevel.MEMORY_AND_DISK) if keep else x
        self.kept, self.bins, self.final_rows = keep, bins, final_rows
        # infinite values sort before and after all others and take no part in the search
        low, high = (F.lit(False), F.lit(False)) if self.integral else (
            F.col("x") == float("-inf"), F.col("x") == float("inf"))
        finite = F.when(~(low | high), F.col("x"))
        sketch = F.kll_sketch_agg_bigint if self.integral else F.kll_sketch_agg_double
        row = self.x.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"),
                         F.max("x").alias("hi"), F.avg("x").alias("mean"),
                         F.stddev_pop("x").alias("std"), F.count_if(low).alias("low"),
                         F.count_if(high).alias("high"), F.min(finite).alias("least"),
                         F.max(finite).alias("most"),
                         sketch(finite, F.lit(SKETCH_K)).alias("sketch")).first()
        self.n, self.lo, self.hi = int(row["n"]), row["lo"], row["hi"]
        self.mean, self.std = row["mean"], row["std"]
        self.low, self.high = int(row["low"]), int(row["high"])
        self.least, self.most, self.sketch = row["least"], row["most"], row["sketch"]

    def __enter__(self) -> OrderStatistics:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def close(self) -> None:
        if self.kept:
            self.x.unpersist()

    def values_at(self, ranks: list[int]) -> dict[int, object]:
        """Values at 0-based ``ranks`` (ascending order)."""
        out: dict[int, object] = {}
        inner = []
        for r in sorted(set(ranks)):
            if not 0 <= r < self.n:
                raise ValueError(f"rank {r} outside 0..{self.n - 1}")
            if r < self.low or r >= self.n - self.high:
                out[r] = float("-inf") if r < self.low else float("inf")
            else:
                inner.append(r - self.low)
        if inner:
            found = self._search(inner)
            out.update({r + self.low: found[r] for r in inner})
        return {r: out[r] for r in ranks}

    def percentiles(self, ps: list[float]) -> dict[float, float | None]:
        """Exact percentiles, linear interpolation at position p·(n−1)."""
        if self.n == 0:
            return {p: None for p in ps}
        pos = {p: p * (self.n - 1) for p in ps}
        ranks = sorted({math.floor(v) for v in pos.values()}
                       | {math.ceil(v) for v in pos.values()})
        vals = self.values_at(ranks)
        out = {}
        for p, v in pos.items():
            a, b = vals[math.floor(v)], vals[math.ceil(v)]
            out[p] = a if a == b else a + (b - a) * (v - math.floor(v))
        return out

    def brackets(self, ranks: list[int]) -> list[tuple[object, object]]:
        """Disjoint ascending value ranges that hold the given ranks of the finite values, but
        for the sketch's small chance of error."""
        n = self.n - self.low - self.high
        if n <= self.final_rows or self.least == self.most:
            return [(self.least, self.most)]
        spread = BRACKET * RANK_ERROR
        wanted = []
        for r in ranks:
            wanted += [max((r + 0.5) / n - spread, 0.0), min((r + 0.5) / n + spread, 1.0)]
        get = (F.kll_sketch_get_quantile_bigint if self.integral
               else F.kll_sketch_get_quantile_double)
        spark = self.x.sparkSession
        sketch = spark.createDataFrame([(self.sketch,)], "s binary")
        values = sketch.select(F.array(*[get("s", F.lit(p)) for p in wanted])).first()[0]
        ends = sorted((self.least if wanted[k] <= 0.0 else values[k],
                       self.most if wanted[k + 1] >= 1.0 else values[k + 1])
                      for k in range(0, len(values), 2))
        out = [ends[0]]
        for lo, hi in ends[1:]:
            if lo <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], hi))
            else:
                out.append((lo, hi))
        return out

    def _search(self, ranks: list[int]) -> dict[int, object]:
        finite = self.x
        if not self.integral:
            finite = finite.where(F.abs("x") < float("inf"))
        ranges = self.brackets(ranks)
        # place 2i: below range i; place 2i + 1: inside range i; the last place: above all
        place: Column = F.lit(2 * len(ranges))
        for i, (lo, hi) in reversed(list(enumerate(ranges))):
            place = (F.when(F.col("x") < F.lit(lo), 2 * i)
                     .when(F.col("x") <= F.lit(hi), 2 * i + 1).otherwise(place))
        placed = finite.select("x", place.alias("place"))
        value = F.when(F.col("place") % 2 == 1, F.col("x")).alias("v")
        counted = (placed.groupBy("place", value).agg(
            F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .persist(StorageLevel.MEMORY_AND_DISK))
        try:
            sums = {r["place"]: r for r in counted.groupBy("place").agg(
                F.sum("c").alias("c"), F.count("v").alias("values"), F.min("lo").alias("lo"),
                F.max("hi").alias("hi")).collect()}
            out: dict[int, object] = {}
            below = 0
            for p in sorted(sums):
                own, count = sums[p], int(sums[p]["c"])
                inside = [r for r in ranks if below <= r < below + count]
                if inside and p % 2:
                    values = counted.where(F.col("place") == p).select(F.col("v").alias("x"), "c")
                    out.update(_weighted(values, inside, own["lo"], own["hi"], below,
                                         int(own["values"]), self.integral, self.bins,
                                         self.final_rows))
                elif inside:      # a rank that its bracket missed
                    gap = finite.where(F.col("x").between(own["lo"], own["hi"])).groupBy("x").agg(
                        F.count(F.lit(1)).alias("c"))
                    out.update(_weighted(gap, inside, own["lo"], own["hi"], below, count,
                                         self.integral, self.bins, self.final_rows))
                below += count
            return out
        finally:
            counted.unpersist()

    def count_below(self, value) -> int:
        return self.x.where(F.col("x") < F.lit(value)).count()


def kth_smallest(df: DataFrame, col: str, ranks: list[int], bins: int = DEFAULT_BINS,
                 final_rows: int = DEFAULT_FINAL_ROWS) -> dict[int, object]:
    """Values at 0-based ``ranks`` of the non-NULL values of ``col`` (ascending)."""
    with OrderStatistics(df, col, bins, final_rows) as st:
        return st.values_at(ranks)


def percentiles(df: DataFrame, col: str, ps: list[float], **kw) -> dict[float, float | None]:
    """Exact percentiles with linear interpolation between closest ranks
    (value at position p·(n−1)), NULL and NaN excluded."""
    with OrderStatistics(df, col, **kw) as st:
        return st.percentiles(ps)


def _weighted(values: DataFrame, ranks: list[int], lo, hi, below: int, distinct: int,
              integral: bool, bins: int, final_rows: int) -> dict[int, object]:
    """Values at ``ranks`` among counted ``values`` (x, c) within [lo, hi], ``below`` lying under
    lo: cumulated counts of at most ``final_rows`` values, after narrowing where there are more."""
    out: dict[int, object] = {}
    if lo == hi:
        return {r: lo for r in ranks}
    if distinct <= final_rows:
        acc = below
        for row in values.where(F.col("x").between(lo, hi)).orderBy("x").collect():
            acc += int(row["c"])
            out.update({r: row["x"] for r in ranks if r not in out and r < acc})
        return out
    if integral:
        step = max(1, math.ceil((int(hi) - int(lo) + 1) / bins))
        bucket = F.expr(f"(x - ({int(lo)})) div {step}")
    else:
        # a range near the largest double is scaled down, or its width would overflow
        part = 1.0 if float(hi) - float(lo) < 1e300 else 4.0 * bins
        bucket = F.width_bucket(F.col("x") / part, F.lit(float(lo) / part),
                                F.lit(float(hi) / part), F.lit(bins))
    hist = (values.where(F.col("x").between(lo, hi)).groupBy(bucket.alias("b"))
            .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("values"),
                 F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("b").collect())
    if len(hist) == 1 and hist[0]["values"] == distinct and (hist[0]["lo"], hist[0]["hi"]) == (
            lo, hi):
        raise RuntimeError(f"no progress on the range {lo}..{hi} with {distinct} values")
    for h in hist:
        inside = [r for r in ranks if below <= r < below + int(h["c"])]
        if inside:
            out.update(_weighted(values, inside, h["lo"], h["hi"], below, int(h["values"]),
                                 integral, bins, final_rows))
        below += int(h["c"])
    return out
