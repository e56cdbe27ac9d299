"""Dimension joins: a checked snapshot is broadcast, a large dimension is joined around its hot keys.

A dimension is broadcast only when one bounded read proves it small: it fetches at most
``max_rows + 1`` rows, so it costs the same whatever the dimension's real size. The rows read are
the rows joined: a small dimension enters the plan as that snapshot, whose key was checked to be
unique (a duplicate key would multiply fact rows silently), so the join needs no second read and no
assertion at run time, and several roles share one read. A larger dimension is asserted unique in
the join's own plan and joined by key; ``skew_join`` spreads the few fact keys that would put too
many rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEFAULT_MAX_BROADCAST_ROWS = 100_000
HOT_SHARE = 0.01      # a key with more than this share of the fact rows is hot
SALTS = 64            # parts that a hot key's fact rows are spread over
TRACKED = 10_000      # keys the heavy-hitter sketch follows in each task


def asserted_unique(dim: DataFrame, key: str) -> DataFrame:
    """``dim`` that fails the running query if a key occurs twice when it is read."""
    per_key = F.count(F.lit(1)).over(Window.partitionBy(key))
    once = F.assert_true(F.col("_per_key") == 1, f"dimension key {key!r} is not unique")
    return dim.withColumn("_per_key", per_key).where(once.isNull()).drop("_per_key")


def dimension_for_join(dim: DataFrame, key: str, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       require_unique: bool = True) -> tuple[DataFrame, bool]:
    """(dimension, whether it is small): a broadcast snapshot of the rows ``dim`` has now, if they
    are at most ``max_rows``; otherwise ``dim`` itself for a join by key. A duplicate key raises:
    now where the snapshot shows it, in the join's own plan where the dimension is large."""
    rows = dim.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return (asserted_unique(dim, key) if require_unique else dim), False
    if require_unique:
        counts = rows[key].value_counts()
        most = max((c["counts"] for c in counts.to_pylist()), default=0)
        if most > 1:
            raise ValueError(f"dimension key {key!r} is not unique (a key occurs {most} times)")
    return F.broadcast(dim.sparkSession.createDataFrame(rows, dim.schema)), True


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE, tracked: int = TRACKED) -> list:
    """Keys that may have more than ``share`` of the rows, from one pass with a heavy-hitter
    sketch of bounded size: every such key is found, at most 1 / share of them are returned."""
    limit = int(1 / share)
    row = fact.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {limit}, {max(tracked, 4 * limit)})").alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] > share * row["n"]]


def skew_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot: list | None = None,
              salts: int = SALTS) -> DataFrame:
    """``fact`` left-joined to a large, unique ``dim`` (``dim_key`` is dropped).

    Fact rows with one of the ``hot`` keys (found by ``hot_keys``, if not given) are spread over
    ``salts`` parts by a hash of the row, and the dimension's rows with these keys, at most one
    each, are repeated for every part; so are fact rows with a null key, which match nothing. All
    other rows join by their key alone, in the same shuffle."""
    hot = hot_keys(fact, fact_key) if hot is None else hot
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salts)).cast("int")
    is_hot = F.lit(False)
    if hot:
        is_hot = F.col(fact_key).isin(hot)
    left = fact.withColumn("_salt", F.when(is_hot | F.col(fact_key).isNull(), spread).otherwise(0))
    parts = F.array(F.lit(0))
    if hot:
        parts = F.when(F.col(dim_key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            parts)
    right = dim.withColumn("_part", F.explode(parts)).withColumnRenamed(dim_key, "_key")
    return (left.join(right, (F.col(fact_key) == F.col("_key")) & (F.col("_salt") == F.col("_part")),
                      "left").drop("_salt", "_part", "_key"))
