"""Exact cosine range join of vectors with equal labels, and the classes its links form.

On unit vectors cos(x, y) >= t means a distance of at most eps = sqrt(2 - 2 t), and distances obey
the triangle inequality. Centres from a bounded sample split the vectors of each label into
Voronoi cells. A vector y whose nearest centre is q can only link with vectors of the cell of p if

    d(y, p) - d(y, q) <= 2 eps   and   d(y, p)^2 - d(y, q)^2 <= 2 eps d(p, q),

the second because half the difference of squares over d(p, q) is its distance from the plane
between p and q. It is replicated to those cells only, and each cell is joined by itself: the links
of a vector are counted in its own cell, which holds all its partners.

Vectors within eps / 2 of a centre link with each other for certain, so such a core is counted and
not compared; a dense group of any size is linear work there. What else a cell holds is compared
in blocks, as matrix products, and leaves one row per vector and block: its number of links, and an
edge to its class in the block. Equal vectors are joined first, by a 128-bit digest, and weigh as
many as they are. How many centres a label gets follows from its size and from the replication
that a sample shows: more of them make smaller cells and more copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.stages import components, small, written
from tripdeck.llm.text import column

SURE = 1e-9  # relative margin by which bounds on rounded distances are widened


def usable_vectors(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, v, ok): ok where the label is not null and the vector is not null, not zero
    and without null or non-finite components. Rows with a null id are left out."""
    v = F.col(vector).cast("array<double>")
    good = (F.col(label).isNotNull() & F.col(vector).isNotNull()
            & F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
            & F.exists(v, lambda c: c != 0))
    return (rows.where(F.col(id_column).isNotNull())
            .select(F.col(id_column).cast("long").alias("id"), F.col(label).alias("label"),
                    F.col(vector).alias("v"), F.coalesce(good, F.lit(False)).alias("ok")))


def scaled(v) -> np.ndarray:
    """Rows of a list column of one length as doubles, each times a power of two that brings its
    largest component to 0.5 to 1: squares neither overflow nor vanish, cosines stay the same."""
    x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def lengths_of(v) -> np.ndarray:
    return np.array([len(x) for x in v], np.int64)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of unit rows from centres."""
    return np.maximum(1 - 2 * x @ centres.T + (centres * centres).sum(1)[None, :], 0.0)


class Cells:
    """Centres for 1, 2, 4, ... cells a label, and which of those numbers suits a label's size.

    A quarter of the sample, which the centres are not fitted to, shows the replication."""

    def __init__(self, sample: np.ndarray, eps: float, most: int, block: int):
        self.eps, self.sets = eps, []
        probe = sample[:len(sample) // 4 + 1]
        sample = sample[len(probe):] if len(sample) > len(probe) else sample
        k = 1
        while k <= most and k <= max(1, len(sample) // 4):
            centres = sample[:k].copy()
            for _ in range(2):
                home = squared(sample, centres).argmin(1)
                total = np.zeros_like(centres)
                np.add.at(total, home, sample)
                count = np.bincount(home, minlength=k)
                centres[count > 0] = (total / np.maximum(count, 1)[:, None])[count > 0]
            self.sets.append(centres)
            k *= 2
        copies = [self.near(probe, c)[1].sum() / max(len(probe), 1) for c in self.sets]

        def cost(n, level):
            """Rows moved and compared per vector, in rows moved; comparing with a block of
            vectors, or with as many centres, counts as one."""
            cells = len(self.sets[level])
            home, all_ = n / cells, n * copies[level] / cells
            moved = copies[level] * max(1, home / block) + max(1, all_ / block)
            return moved + (all_ + cells) / block
        self.levels = [min(range(len(self.sets)), key=lambda s, n=1 << b: cost(n, s))
                       for b in range(62)]

    def near(self, x: np.ndarray, centres: np.ndarray):
        """Squared distances of unit rows from the centres, and where each row has to go."""
        d2 = squared(x, centres)
        own = d2.argmin(1)
        least = d2[np.arange(len(x)), own][:, None]
        gap = np.sqrt(squared_between(centres))[own]
        plane = d2 - least <= 2 * self.eps * gap + SURE
        reach = np.sqrt(d2) - np.sqrt(least) <= 2 * self.eps + SURE
        goes = plane & reach
        goes[np.arange(len(x)), own] = True
        return d2, goes, own


def squared_between(c: np.ndarray) -> np.ndarray:
    s = (c * c).sum(1)
    return np.maximum(s[:, None] + s[None, :] - 2 * c @ c.T, 0.0)


def fit_cells(vectors: DataFrame, eps: float, most: int, block: int) -> dict[int, Cells]:
    """Cells for each vector length, from at most 4 * ``most`` vectors chosen by their digest."""
    rows = vectors.orderBy("h", "uid").limit(4 * most).select("v").toArrow()["v"].combine_chunks()
    out, n = {}, lengths_of(rows)
    for dims in np.unique(n):
        x = scaled(rows.take(pa.array(np.flatnonzero(n == dims))))
        out[int(dims)] = Cells(x / np.linalg.norm(x, axis=1)[:, None], eps, most, block)
    return out


def placed(vectors: DataFrame, cells: dict[int, Cells], eps: float) -> DataFrame:
    """(label, dims, cell, home, core, uid, id, w, v): a row for each cell that a vector goes to;
    ``core`` if it is within eps / 2 of the centre. ``bits`` is the length in bits of its label's
    number of vectors."""
    kind = vectors.schema
    label, v_type = kind["label"].dataType.simpleString(), kind["v"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            v, bits = column(batch, "v"), column(batch, "bits").to_numpy()
            n = lengths_of(v)
            for dims in np.unique(n):
                for b in np.unique(bits[n == dims]):
                    at = np.flatnonzero((n == dims) & (bits == b))
                    for a in range(0, len(at), 4096):
                        yield copies(batch, v, at[a:a + 4096], int(dims), int(b))

    def copies(batch, v, at, dims, b):
        rows = pa.array(at)
        x = scaled(v.take(rows))
        x /= np.linalg.norm(x, axis=1)[:, None]
        if dims in cells:
            own = cells[dims]
            centres = own.sets[own.levels[b]]
            d2, goes, home = own.near(x, centres)
        else:   # a length the sample missed: one cell round the origin
            d2, goes, home = np.ones((len(x), 1)), np.ones((len(x), 1), bool), np.zeros(len(x))
        k, cell = np.nonzero(goes)
        core = np.sqrt(d2[k, cell]) <= eps / 2 * (1 - SURE) - SURE
        part = batch.take(pa.array(at[k]))
        return pa.RecordBatch.from_arrays(
            [column(part, "label"), pa.array(np.full(len(k), dims, np.int32)),
             pa.array(cell.astype(np.int32)), pa.array(cell == home[k]), pa.array(core),
             *(column(part, c) for c in ("uid", "id", "w", "v"))],
            ["label", "dims", "cell", "home", "core", "uid", "id", "w", "v"])
    return vectors.mapInArrow(run, f"label {label}, dims int, cell int, home boolean, "
                              f"core boolean, uid long, id long, w long, v {v_type}")


def linked_blocks(homes, others, least: float):
    """Links of the vectors of a home block with those of another: (uid, id, links, root), a row
    for each vector of either block that has any. ``links`` counts the partners of home vectors
    with their weights (0 for others), ``root`` is the id of one vector of its class."""
    a, b = (scaled(t["v"].combine_chunks()) for t in (homes, others))
    na, nb = ((x * x).sum(1) for x in (a, b))
    a_uid, b_uid = homes["uid"].to_numpy(), others["uid"].to_numpy()
    w = others["w"].to_numpy()
    uid = np.concatenate((a_uid, b_uid))
    node = np.unique(uid, return_inverse=True)[1]
    node_a, node_b = node[:len(a)], node[len(a):]
    root = np.arange(node.max() + 1)
    links = np.zeros(len(a), np.int64)
    for s in range(0, len(a), 256):
        cos = (a[s:s + 256] @ b.T) / (np.sqrt(na[s:s + 256])[:, None] * np.sqrt(nb)[None, :])
        hit = (cos >= least) & (a_uid[s:s + 256, None] != b_uid[None, :])
        links[s:s + 256] = hit @ w
        for k in np.flatnonzero(hit.any(1)):
            met = np.unique(np.append(root[node_b[hit[k]]], root[node_a[s + k]]))
            if len(met) > 1:
                root[np.isin(root, met[1:])] = met[0]
    ids = np.concatenate((homes["id"].to_numpy(), others["id"].to_numpy()))
    name = np.zeros(len(root), np.int64)
    name[node] = ids
    own = np.zeros(len(root), np.int64)
    own[node_a] = links
    size = np.bincount(root, minlength=len(root))
    first = np.unique(node, return_index=True)[1]
    some = np.flatnonzero(size[root] > 1)
    return (uid[first[some]], name[some], own[some], name[root[some]])


def range_links(vectors: DataFrame, least: float, most: int = 1024, block: int = 4096):
    """Links (cosine at least ``least``) of ``vectors`` (uid, h, label, id, w, v), all different:
    (uid, links, id, root) rows, whose links sum up to a vector's weighted partners and whose
    edges (id, root) connect each class."""
    eps = float(np.sqrt(max(2 - 2 * least, 0.0))) * (1 + SURE)
    vectors = written(vectors, "metric-vectors")
    size = vectors.groupBy("label").count().where(F.col("count") > block)
    bits = F.length(F.bin("count")).cast("int").alias("bits")
    vectors = (vectors.join(small(written(size.select("label", bits), "large-labels")), "label",
                            "left").fillna(0, ["bits"]))
    copies = written(placed(vectors, fit_cells(vectors, eps, most, block), eps), "metric-cells")

    cell = ["label", "dims", "cell"]
    core = (copies.where("core").groupBy(*cell)
            .agg(F.sum("w").alias("core_w"), F.min("id").alias("root"))
            .withColumns({f"of_{c}": F.col(c) for c in cell}).drop(*cell))
    core = small(written(core, "metric-cores"))
    sure = (copies.where("core").drop("v")
            .join(core, [F.col(c) == F.col(f"of_{c}") for c in cell])
            .select("uid", F.expr("if(home, core_w - w, 0)").alias("links"), "id", "root"))

    # blocks of a cell: its core ones first; core against core is known
    sizes = (copies.groupBy(*cell)
             .agg(F.ceil(F.count_if("core") / block).alias("cores"),
                  F.ceil(F.count_if(~F.col("core")) / block).alias("rest"),
                  F.count_if("home").alias("homes"))
             .where("homes > 0"))
    sizes = small(written(sizes.drop("homes"), "metric-blocks"))
    spot = F.pmod(F.xxhash64("uid"), F.expr("if(core, cores, rest)"))
    dealt = (copies.join(sizes, cell)
             .withColumn("own", F.expr("if(core, 0, cores)") + spot))
    other = F.expr("explode(sequence(if(core, cores, 0), cores + rest - 1))")
    dealt = dealt.where("not core or rest > 0")
    keys = [*cell, "i", "j"]
    left = dealt.where("home").withColumn("j", other).withColumnRenamed("own", "i")
    right = dealt.withColumn("i", other).withColumnRenamed("own", "j")
    take = [F.col(c).alias(c) for c in (*keys, "uid", "id", "w", "v")]

    def run(homes, others):
        if not homes.num_rows or not others.num_rows:
            found = [[], [], [], []]
        else:
            found = linked_blocks(homes, others, least)
        uid, name, own, root = (pa.array(x, pa.int64()) for x in found)
        return pa.table([uid, own, name, root], names=["uid", "links", "id", "root"])
    met = (left.select(*take).groupBy(*keys).cogroup(right.select(*take).groupBy(*keys))
           .applyInArrow(run, "uid long, links long, id long, root long"))
    return written(met.union(sure), "metric-links")


def cosine_classes(rows: DataFrame, id_column: str, vector: str, label: str,
                   least: float = 0.98, most: int = 1024, block: int = 4096) -> DataFrame:
    """(id, n_links, component_id, kept), a row per row of ``rows`` with an id.

    Two rows link if their labels are equal and not null and the cosine of their vectors, in
    double precision, is at least ``least`` (0 to 1). Null and zero vectors, and those with null
    or non-finite components, link with nothing, as do vectors of different lengths. n_links
    counts the other rows a row links with; component_id is the smallest id reachable by links;
    kept where that is its own. Rows that share an id are one node with the links of any of them.
    Repeated rows link with each other. Extra columns are ignored; an empty table gives no rows.
    At most 4 * ``most`` vectors and ``most`` centres reach the driver and every task.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0, at most 1")
    all_rows = written(usable_vectors(rows, id_column, vector, label)
                       .withColumn("h", F.xxhash64("label", "v"))
                       .withColumn("h2", F.xxhash64(F.lit(1), "label", "v"))
                       .withColumn("uid", F.monotonically_increasing_id()), "metric-rows")
    good = all_rows.where("ok")
    same = written(good.groupBy("label", "h", "h2")
                   .agg(F.min(F.struct("id", "uid")).alias("first"),
                        F.count(F.lit(1)).alias("w")), "equal-vectors")
    same = same.select("label", "h", "h2", "w", F.col("first.id").alias("rep"),
                       F.col("first.uid").alias("rep_uid"))
    member = good.select("uid", "id", "label", "h", "h2")
    again = written(member.join(small(same.where("w > 1")), ["label", "h", "h2"])
                    .select("uid", "id", "rep", "rep_uid", "w"), "repeated-vectors")
    weight = again.where("uid = rep_uid").select("uid", "w")
    others = again.where("uid <> rep_uid")
    vectors = (good.join(small(others.select("uid")), "uid", "left_anti")
               .join(small(weight), "uid", "left")
               .select("uid", "h", "label", "id", F.coalesce("w", F.lit(1).cast("long"))
                       .alias("w"), "v"))
    links = range_links(vectors, least, most, block)
    comp = components(links.select(F.col("id").alias("a"), F.col("root").alias("b"))
                      .union(again.select("id", "rep")))
    count = links.groupBy("uid").agg(F.sum("links").alias("links")).where("links > 0")
    of = again.select("uid", "rep_uid", "w")
    return (all_rows.select("uid", "id").join(small(of), "uid", "left")
            .withColumn("rep_uid", F.coalesce("rep_uid", "uid"))
            .join(count.withColumnRenamed("uid", "rep_uid"), "rep_uid", "left")
            .join(comp.select(F.col("node").alias("id"), "component"), "id", "left")
            .select("id", (F.coalesce("links", F.lit(0)) + F.coalesce("w", F.lit(1)) - 1)
                    .cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col("id") == F.col("component_id")))
