"""Written intermediate tables and connected components, shared by the operators.

Intermediate tables go below the shared folder that ``spark.checkpoint.dir`` names and are read
back from there, so a lost executor costs at most the tasks of the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.session import scratch_path

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
SMALL_ROWS = 1_000_000  # narrow rows that are broadcast at most


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to shared scratch space and read back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` from here on, unless the session has a limit of its
    own. Spark's 64 MB of texts are held several times over by every running task, in the JVM and
    in its Python worker; the operators slice texts anyway."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` (of narrow rows, cheap to read) to be broadcast if it has at most ``rows`` rows;
    otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a long, b long): (node, component),
    one row per node of any edge, component being its smallest node.

    Alternating large-star / small-star contraction: each round is two joins against per-node
    minima, so a node with a huge neighbourhood is only ever partially aggregated or split by
    the adaptive join; the number of rounds grows with the logarithm of the longest path. Nulls
    and self-loops are ignored; an empty input gives an empty result. Each round's edges are
    written. Raises if ``max_rounds`` don't suffice.
    """
    def minima(e: DataFrame, both: bool) -> DataFrame:
        near = e.select(F.col("hi").alias("n"), F.col("lo").alias("m"))
        if both:
            near = near.union(e.select(F.col("lo").alias("n"), F.col("lo").alias("m")))
        return near.groupBy("n").agg(F.min("m").alias("m"))

    def oriented(df: DataFrame) -> DataFrame:
        return (df.where("a <> b")
                .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                .distinct())

    cur = written(oriented(edges.select("a", "b")), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = cur.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        if mark["n"] == 0 or mark == seen:
            return (cur.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
                    .union(cur.select("lo", "lo")).distinct())
        seen = mark
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        large = oriented(cur.join(minima(cur, True), cur["lo"] == F.col("n"))
                         .select(F.col("hi").alias("a"), F.col("m").alias("b"))
                         .union(cur.join(minima(cur, True), cur["hi"] == F.col("n"))
                                .select(F.col("hi").alias("a"), F.col("m").alias("b"))))
        large = written(large, "large-star")
        # small star: the smaller neighbours of a node, and the node, move to its smallest one
        small = (large.join(minima(large, False), large["hi"] == F.col("n"))
                 .select(F.col("lo").alias("a"), F.col("m").alias("b"))
                 .union(minima(large, False).select(F.col("n").alias("a"), F.col("m").alias("b"))))
        cur = written(oriented(small), "small-star")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
