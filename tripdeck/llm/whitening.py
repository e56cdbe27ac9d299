"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

The n centred vectors are the rows of a matrix A that is never formed: a task centres its block
of integer vectors exactly, as (n x - S) / n, and multiplies. From a unit vector v_1 the steps

    alpha_j u_j = A v_j - beta_{j-1} u_{j-1},    beta_j v_{j+1} = A'u_j - alpha_j v_j

give orthonormal v_j and u_j and a bidiagonal B with A V = U B, whose singular values and right
vectors become the deviations and components. Both sides are fully reorthogonalised. The long
vectors u_j are not stored: each lies in the image of A, u_j = A w_j, so a task has its part of
all of them as A W with a small W. One pass over the vectors a step returns U'u, |u|^2 and A'u,
summed over the tasks; earlier A'u_j already give the first round of U'(A v).

A step that finds nothing new (beta or alpha of 0) goes on with another direction, so rank
deficiency and repeated eigenvalues end well: after as many steps as dimensions, V is a whole
basis. It ends earlier where the wanted triplets have settled and what is left of the trace is
below the least of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.stages import written
from tripdeck.llm.text import column

BLOCK_BYTES = 2 << 20
SETTLED = 1e-13  # residual of a triplet against the largest singular value
NO_U = 1e-11     # a left vector shorter than this against |A| is none; it counts squared
NO_V = 1e-16     # likewise a right vector, whose coupling counts in full


def integer_grid(rows: DataFrame, id_column: str, vector: str, scale: int,
                 shift: int) -> DataFrame:
    """(id, x): x = floor(scale * c) + shift of each component c, as long. Rows whose vector is
    null or holds null or non-finite entries are left out; null ids stay."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return (rows.where(F.col(vector).isNotNull()).where(good)
            .select(F.col(id_column).cast("long").alias("id"),
                    F.transform(v, lambda c: F.floor(c * scale) + F.lit(shift).cast("long"))
                    .alias("x")))


def blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """(ids, x): up to 2 MB of vectors a row, as their ids and one little-endian int64 matrix."""
    step = max(1, BLOCK_BYTES // (8 * dims))

    def pack(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                x = column(part, "x").flatten().to_numpy(zero_copy_only=False)
                ids = column(part, "id")
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([x.astype("<i8").tobytes()], pa.binary())], ["ids", "x"])
    return (vectors.where(F.size("x") == dims)
            .mapInArrow(pack, "ids array<long>, x binary"))


def matrices(batch, dims: int):
    """The int64 matrices of a batch of blocks."""
    for x in column(batch, "x"):
        yield np.frombuffer(x.as_py(), "<i8").reshape(-1, dims)


def summed(table: DataFrame, dims: int, part, kind=np.float64) -> np.ndarray:
    """The sum over all blocks of ``part(matrix)``, a flat array: a partial sum a task, added up
    in one further task that sees nothing but partial sums."""
    def each(batches):
        total = None
        for batch in batches:
            for x in matrices(batch, dims):
                own = part(x)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.asarray(total, kind).tobytes()], pa.binary())], ["s"])

    def add(batches):
        total = None
        for batch in batches:
            for s in column(batch, "s"):
                own = np.frombuffer(s.as_py(), kind)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])
    # one row; first() would stop the Python worker before its end and cost a new one each time
    [row] = table.mapInArrow(each, "s binary").repartition(1).mapInArrow(add, "s binary").collect()
    return np.frombuffer(row["s"], kind)


def orthogonal(p: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``p`` without its parts along the orthonormal columns of ``basis``, taken out twice."""
    for _ in range(2):
        p = p - basis @ (basis.T @ p)
    return p


def bidiagonalise(product, dims: int, wanted: int, trace: float, seed: int = 0):
    """(sigma, right): singular values, falling, and right vectors as columns, of the matrix A
    that ``product(W, w) -> (W'A'u, u'u, A'u) with u = A w`` stands for; ``trace`` is its squared
    Frobenius norm. The first ``wanted`` are settled (all, if there are no more)."""
    rng = np.random.default_rng(seed)
    V, W, Z = (np.zeros((dims, 0)) for _ in range(3))
    B = np.zeros((dims, dims))
    size = np.sqrt(trace)
    v = rng.normal(size=dims)
    v /= np.linalg.norm(v)
    k = 0
    while k < dims:
        # first round against the earlier u: U'(A v) = (A'U)'v; the pass measures the second
        w = v - W @ (Z.T @ v)
        h, square, r = product(W, w)
        w, r = w - W @ h, r - Z @ h
        alpha = np.sqrt(max(square - h @ h, 0.0))
        V = np.column_stack([V, v])
        if alpha <= NO_U * size:      # A v lies in the earlier u: no u of its own
            alpha, w, r = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w, r = w / alpha, r / alpha
        W, Z = np.column_stack([W, w]), np.column_stack([Z, r])
        B[k, k] = alpha
        k += 1
        if k == dims:
            break
        p = orthogonal(r, V)
        beta = np.linalg.norm(p)
        if beta <= NO_V * size:
            p, beta = orthogonal(rng.normal(size=dims), V), 0.0
        v = orthogonal(p / np.linalg.norm(p), V)
        v /= np.linalg.norm(v)
        B[k - 1, k] = beta
        if k >= wanted and (k - wanted) % 4 == 0:
            left, sigma, _ = np.linalg.svd(B[:k, :k])
            loose = beta * np.abs(left[-1, :wanted]).max()
            unseen = trace - (sigma ** 2).sum()
            if loose <= SETTLED * sigma[0] and unseen < sigma[wanted - 1] ** 2:
                break
    _, sigma, right = np.linalg.svd(B[:k, :k])
    return sigma, V @ right.T


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: ``n`` vectors of ``dims`` entries with sums ``total`` (exact);
    ``axes`` holds the components as columns, ``values`` their eigenvalues."""

    n: int
    dims: int
    total: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    table: DataFrame

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.values]

    def centred(self):
        """A function from a block to its centred rows, n x - S in exact integers over n."""
        n, total = self.n, np.array(self.total, np.int64)
        return lambda x: (x * n - total) / n

    def rows(self) -> DataFrame:
        """(id, n, deviation, whitened): per vector the exact sum of (n x - S)^2 and its whitened
        coordinates, one per component."""
        kind = "id long, n long, deviation decimal(38,0), whitened array<double>"
        if not self.n:
            return self.table.sparkSession.createDataFrame([], kind)
        n, dims, total = self.n, self.dims, np.array(self.total, np.int64)
        scaled, centred = self.axes / np.sqrt(self.values), self.centred()

        def run(batches):
            for batch in batches:
                for ids, x in zip(column(batch, "ids"), matrices(batch, dims), strict=True):
                    y = np.ascontiguousarray(centred(x) @ scaled)
                    at = np.arange(len(x) + 1, dtype=np.int32) * scaled.shape[1]
                    whitened = pa.ListArray.from_arrays(pa.array(at), pa.array(y.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [ids.values, pa.array(np.full(len(x), n)), squares(x * n - total),
                         whitened], ["id", "n", "deviation", "whitened"])
        return self.table.mapInArrow(run, kind)

    def identity_error(self) -> float | None:
        """Largest absolute entry of the whitened vectors' covariance minus the identity."""
        k = len(self.values)
        if not k:
            return None
        scaled, centred = self.axes / np.sqrt(self.values), self.centred()

        def part(x):
            y = centred(x) @ scaled
            return np.concatenate((y.sum(0), (y.T @ y).ravel()))
        sums = summed(self.table, self.dims, part) / self.n
        cov = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
        return float(np.abs(cov - np.eye(k)).max())


def squares(z: np.ndarray) -> pa.Array:
    """Exact sums of squares of integer rows, as decimal(38,0)."""
    if z.size and float(np.abs(z).max()) ** 2 * z.shape[1] < 2.0 ** 62:
        return pa.array((z * z).sum(1)).cast(pa.decimal128(38, 0))
    return pa.array([sum(int(v) ** 2 for v in row) for row in z], pa.decimal128(38, 0))


def whitening(vectors: DataFrame, components: int = 32, seed: int = 0) -> Whitening:
    """Fits on all ``vectors`` (id, x) with integer entries; see ``Whitening``.

    Eigenvectors of the covariance with divisor n, by falling eigenvalue; directions without
    variance (below 1e-20 of the trace) are no components, so there may be fewer than asked, and
    none for a single vector or equal ones. Vectors of another length than the most frequent one
    (on a tie the longest) are left out; repeated rows count as often as they occur; ids play no
    part and may be null or repeated. Without vectors, or with empty ones only, ``n`` is 0 and
    there are no rows. Extra columns are ignored. Raises where n times an entry goes beyond 62
    bits, as the exact sums would.
    """
    lengths = (vectors.groupBy(F.size("x").alias("dims"))
               .agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("x")).alias("most"),
                    F.min(F.array_min("x")).alias("least")).where("dims > 0")
               .orderBy(F.desc("n"), F.desc("dims")).first())
    none = np.zeros(0)
    if lengths is None:
        return Whitening(0, 0, (), none, none, 0.0, vectors.limit(0))
    n, dims = lengths["n"], lengths["dims"]
    if max(abs(lengths["most"]), abs(lengths["least"])) * n >= 1 << 62:
        raise OverflowError("entries too large for exact sums in 64 bits")
    table = written(blocks(vectors.select("id", "x"), dims), "vector-blocks")
    sums = summed(table, dims, lambda x: x.sum(0), np.int64)
    fitted = Whitening(n, dims, tuple(int(s) for s in sums), np.zeros((dims, 0)), none, 0.0,
                       table)
    centred = fitted.centred()
    trace = float(summed(table, dims, lambda x: np.array([(centred(x) ** 2).sum()]))[0])
    if trace == 0.0:
        return fitted

    def product(W, w):
        def part(x):
            a = centred(x)
            u = a @ w
            return np.concatenate(((a @ W).T @ u, [u @ u], a.T @ u))
        got = summed(table, dims, part)
        k = W.shape[1]
        return got[:k], got[k], got[k + 1:]

    sigma, axes = bidiagonalise(product, dims, min(components, dims), trace, seed)
    kept = np.flatnonzero(sigma[:components] ** 2 > 1e-20 * trace)
    return Whitening(n, dims, fitted.total, axes[:, kept], sigma[kept] ** 2 / n, trace / n, table)
