"""Exact top-k inner products by a Voronoi join.

Pivots from a bounded sample split all vectors into cells, each vector going to its nearest
pivot. A cell's summary is its number of vectors and its radius. As q.x = q.p + q.(x - p), no
vector of a cell scores above q.p + |q| radius. Each query is first solved in its own cell, which
gives the score to beat; it is then replicated only to cells whose bound reaches that score, and
solved there. Cells and queries are cut into blocks, so neither a hot cell nor many queries meet
in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripdeck.llm.stages import written
from tripdeck.llm.text import column

LARGEST = float(1 << 53)


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component, as doubles. Rows with a null id, a null or
    empty vector, or a component that is null or not finite, take no part."""
    x = F.col(vector).cast("array<double>")
    good = (F.size(x) > 0) & F.forall(x, lambda c: F.coalesce(
        F.abs(c) < float("inf"), F.lit(False)))
    return (rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(good)
            .select(F.col(id_column).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v")))


def matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, as int64 (Python integers, if too large)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = a.shape[1] * np.abs(a).max() * np.abs(b).max()
    if bound < LARGEST:
        return (a @ b.T).astype(np.int64)
    if bound >= 2.0 ** 62:
        raise OverflowError("inner products beyond 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def local_top(query_ids, queries, ids, vectors, k: int):
    """(query id, id, score) of each query's k best of ``ids``, its own id left out; ties go to
    the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    out = []
    for a in range(0, len(queries), 256):
        score = dot(queries[a:a + 256], vectors)
        for q, row in zip(query_ids[a:a + 256], score, strict=True):
            place = np.flatnonzero(ids != q)
            if len(place) > k:
                worst = -np.partition(-row[place], k - 1)[k - 1]
                place = place[row[place] >= worst]
                place = place[np.argsort(-row[place], kind="stable")[:k]]
            out += [(q, int(ids[p]), int(row[p])) for p in place]
    return out


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int, pivots: int = 64,
                       block: int = 4096, query_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by inner product, ranks from 1.

    Both inputs are (id, v) with integer-valued components. A query's own id is no candidate;
    with fewer than k candidates all are given; ties go to the smaller id. Repeated ids on either
    side count once (an arbitrary one of their vectors). Only vectors of a query's length are its
    candidates. ``pivots`` vectors, chosen by hash, are sent to every task; a cell's blocks hold
    about ``block`` vectors and meet about ``query_block`` queries at a time.
    """
    vectors, queries = (x.dropDuplicates(["id"]) for x in (vectors, queries))
    sample = vectors.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(pivots).collect()
    by_length: dict[int, np.ndarray] = {}
    for r in sample:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    by_length = {n: np.unique(np.array(v), axis=0) for n, v in by_length.items()}

    def assign(batches):
        for batch in batches:
            v = column(batch, "v")
            length = np.array([len(x) for x in v], np.int64)
            cell, gap = np.full(len(v), -1, np.int32), np.zeros(len(v))
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                x = matrix(v.take(pa.array(own)))
                p = by_length.get(int(n), np.zeros((1, int(n))))  # no pivot: one cell round 0
                d = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)[None, :]
                cell[own] = d.argmin(1)
                gap[own] = np.sqrt(((x - p[cell[own]]) ** 2).sum(1)) * (1 + 1e-9)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), v, pa.array(length.astype(np.int32)), pa.array(cell),
                 pa.array(gap)], ["id", "v", "dims", "cell", "gap"])

    kind = "id long, v array<double>, dims int, cell int, gap double"
    placed = written(vectors.mapInArrow(assign, kind), "voronoi-vectors")
    asked = written(queries.mapInArrow(assign, kind), "voronoi-queries")
    cells = placed.groupBy("dims", "cell").agg(F.count(F.lit(1)).alias("n"),
                                               F.max("gap").alias("radius"))
    # bounded: at most one cell a pivot, and one for each other length
    summary = {(r["dims"], r["cell"]): (r["radius"], -(-r["n"] // block))
               for r in cells.collect()}
    query_parts = max(1, -(-asked.count() // query_block))

    blocks = F.broadcast(cells.select("dims", "cell",
                                      F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    stored = (placed.join(blocks, ["dims", "cell"])
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .select("dims", "cell", "block", "id", "v"))

    def spread(targets):
        """Query rows (dims, cell, block, part, id, v) for the cells that ``targets`` gives."""
        def run(batches):
            for batch in batches:
                ids = column(batch, "id").to_numpy(zero_copy_only=False)
                dims = column(batch, "dims").to_numpy(zero_copy_only=False)
                rows = [(int(dims[i]), cell, b, i) for i in range(len(ids))
                        for cell in targets(batch, i) if (int(dims[i]), cell) in summary
                        for b in range(summary[int(dims[i]), cell][1])]
                if rows:
                    d, c, b, i = (pa.array(x, pa.int32()) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [d, c, b, column(batch, "id").take(i), column(batch, "v").take(i)],
                        ["dims", "cell", "block", "id", "v"])
        return run

    def solve(replicated):
        keys = ["dims", "cell", "block", "part"]
        left = written(replicated.withColumn(
            "part", F.pmod(F.xxhash64("id"), F.lit(query_parts)).cast("int")), "voronoi-asked")
        wanted = left.select(*[F.col(c).alias(f"to_{c}") for c in keys]).distinct().toDF(*keys)
        right = stored.join(wanted, ["dims", "cell", "block"])

        def run(key, q, x):
            rows = local_top(q["id"].to_numpy(), matrix(q["v"].combine_chunks()),
                             x["id"].to_numpy(), matrix(x["v"].combine_chunks()), k)
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.table([pa.array(c, pa.int64()) for c in cols],
                            names=["query_id", "vec_id", "score"])
        return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
                .applyInArrow(run, "query_id long, vec_id long, score long"))

    def best(found):
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))

    own = lambda batch, i: [int(column(batch, "cell")[i].as_py())]
    home = written(best(solve(asked.mapInArrow(
        spread(own), "dims int, cell int, block int, id long, v array<double>"))), "voronoi-home")
    beat = home.where(F.col("rank") == k).select(F.col("query_id").alias("id"),
                                                 F.col("score").alias("beat"))

    def reachable(batch, i):
        """Cells, the query's own apart, that may hold a score of at least the one to beat."""
        v = np.array(column(batch, "v")[i].as_py())
        floor, home_cell = column(batch, "beat")[i].as_py(), column(batch, "cell")[i].as_py()
        p = by_length.get(len(v), np.zeros((1, len(v))))
        centre, norm = p @ v, np.sqrt((v * v).sum())
        for cell in range(len(p)):
            if cell != home_cell and (len(v), cell) in summary:
                bound = centre[cell] + norm * summary[len(v), cell][0]
                if floor is None or bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= floor:
                    yield cell

    away = solve(asked.join(beat, "id", "left").mapInArrow(
        spread(reachable), "dims int, cell int, block int, id long, v array<double>"))
    return (best(home.select("query_id", "vec_id", "score").union(away))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
