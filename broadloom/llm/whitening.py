"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Vectors become integers, so their sums and deviations are exact. Tasks return sums
and centred scatters of their rows, which Spark adds up; what reaches the driver is
one matrix for a vector length, whatever the number of rows. The scatter A is
factored as P A P' = L L' by Cholesky with the largest pivot first; rotations of
pairs of columns of L make these orthogonal. Then their squared norms are the
eigenvalues of A and the normalised columns its eigenvectors, found from the
factor itself, without squaring it again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Pivots below this share of the first count as zero, and cosines of columns below it as orthogonal.
RANK_TOLERANCE, JACOBI_TOLERANCE, MAX_SWEEPS = 1e-13, 1e-15, 60
#: Partial matrices are first added in so many groups for each of their rows.
PARTIAL_GROUPS = 32


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with scatter[order][:, order] = L L', L lower trapezoidal with a column for each of the matrix's rank."""
    a, d = np.array(scatter, np.float64), len(scatter)
    order, factor = np.arange(d), np.zeros((d, d))
    left = a.diagonal().copy()
    first = left.max(initial=0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= RANK_TOLERANCE * first or left[p] <= 0:
            return factor[:, :k], order
        if p != k:
            for x in (order, left, factor, a):
                x[[k, p]] = x[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
        root = np.sqrt(left[k])
        factor[k, k] = root
        factor[k + 1 :, k] = (a[k + 1 :, k] - factor[k + 1 :, :k] @ factor[k, :k]) / root
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times an orthogonal matrix that makes its columns orthogonal, the longest first.

    A sweep visits every pair of columns once, in rounds of disjoint pairs that are rotated together.
    """
    g = np.array(factor, np.float64)
    r = g.shape[1]
    seats = np.arange(r + r % 2)  # with an odd number one seat stays empty
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[: len(seats) // 2 - 1 : -1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            x, y = g[:, p], g[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max(initial=0)))
            turn = cosine > JACOBI_TOLERANCE
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            x, y = x[:, turn], y[:, turn]
            g[:, p[turn]], g[:, q[turn]] = c * x - s * y, s * x + c * y
            seats[1:] = np.roll(seats[1:], 1)
        if worst <= JACOBI_TOLERANCE * max(r, 1):
            break
    return g[:, np.argsort(-(g * g).sum(axis=0), kind="stable")]


@dataclass(frozen=True)
class Whitening:
    """Fitted to ``n`` vectors of one length: their sums, eigenvalues of the covariance and unit components in columns."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n*x - S as exact integers, and x - S/n."""
        far = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        whole = x * self.n - self.sums if far < 1 << 62 else x.astype(object) * self.n - self.sums.astype(object)
        return whole, whole.astype(np.float64) / self.n

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.components) / np.sqrt(self.values)


def fit_components(n: int, sums: np.ndarray, scatter: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Components of the covariance scatter / n with the largest eigenvalues, at most its rank."""
    factor, order = pivoted_cholesky(scatter / n)
    rotated = one_sided_jacobi(factor)[:, :components]
    values = (rotated * rotated).sum(axis=0)
    vectors = np.empty_like(rotated)
    vectors[order] = rotated / np.sqrt(values)
    return Whitening(n, sums, float(np.trace(scatter) / n), values, vectors)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, an array of floor(SCALE * c) + OFFSET, of vectors without null or non-finite entries."""
    v = F.col("v")
    sound = F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.coalesce(F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(sound).select("vec_id", F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of a batch's rows and their vectors as a matrix, for each vector length."""
    lists = batch.column("x")
    sizes = lists.value_lengths().to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), size)



def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """For each vector length the number of rows and the sum of ``part``'s matrices over all blocks of rows.

    Tasks add up their own blocks and return the matrix by rows; these are added by
    place, in groups of tasks first, so no task or group grows with the input.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in _blocks(batch):
                got = part(x)
                have = found.get(x.shape[1])
                found[x.shape[1]] = [len(x), got] if have is None else [have[0] + len(x), have[1] + got]
        for size, (n, total) in found.items():
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_pydict({"size": [size], "i": [i], "n": [n], "row": [row]}, schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        rows_ = table.column("row").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        return pa.Table.from_pydict({"size": [table["size"][0].as_py()], "i": [table["i"][0].as_py()], "n": [sum(table["n"].to_pylist())], "row": [rows_.sum(axis=0)]}, schema=schema)

    schema = pa.schema([("size", pa.int64()), ("i", pa.int64()), ("n", pa.int64()), ("row", pa.list_(pa.int64() if kind == "long" else pa.float64()))])
    ddl = f"size long, i long, n long, row array<{kind}>"
    parts = rows.mapInArrow(partial, ddl)
    parts = parts.groupBy("size", "i", F.pmod(F.spark_partition_id(), F.lit(PARTIAL_GROUPS)).alias("part")).applyInArrow(merge, ddl)
    out: dict[int, dict] = {}
    for r in parts.groupBy("size", "i").applyInArrow(merge, ddl).collect():
        out.setdefault(r.size, {})[r.i] = (r.n, r.row)
    return {size: (by[0][0], np.array([by[i][1] for i in sorted(by)])) for size, by in out.items()}


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of every vector length of integer_vectors()."""
    sums = {size: (n, s[0]) for size, (n, s) in _summed(rows, lambda x: x.sum(axis=0, keepdims=True), "long").items()}
    means = {size: Whitening(n, s, 0.0, np.empty(0), np.empty((size, 0))) for size, (n, s) in sums.items()}

    def scatter(x: np.ndarray) -> np.ndarray:
        z = means[x.shape[1]].centred(x)[1]
        return z.T @ z

    return {size: fit_components(n, sums[size][1], a, components) for size, (n, a) in _summed(rows, scatter, "double").items()}


def identity_errors(rows: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """For each vector length the largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""

    def moments(x: np.ndarray) -> np.ndarray:
        model = models[x.shape[1]]
        w = model.whiten(model.centred(x)[1])
        return np.vstack([w.sum(axis=0), w.T @ w])

    out = {}
    for size, (n, m) in _summed(rows, moments, "double").items():
        # rows are centred before they are multiplied; what rounding leaves of their mean is taken off
        cov = m[1:] / n - np.outer(m[0] / n, m[0] / n)
        out[size] = float(np.abs(cov - np.eye(len(cov))).max(initial=0))
    return out


def whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows vec_id, component, n, deviation, whitened, explained, identity_error: one for each vector and component.

    Vectors that are null, empty, or hold a null or non-finite entry are dropped.
    Components are numbered from 1 by falling eigenvalue, ``components`` at most and
    no more than the covariance has rank (a list of equal vectors gives no row, as
    does an empty table). Vectors of different lengths are different fits, each with
    an n of its own. Repeated rows, null ids and repeated ids are rows like others;
    other columns are not read. deviation is exact; one that no long can hold is an error.
    """
    rows = integer_vectors(vectors, id_col, vector_col)
    models = fit_whitening(rows, components)
    errors = identity_errors(rows, models)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for i in range(0, whole_batch.num_rows, 2000):
                batch = whole_batch.slice(i, 2000)
                for at, x in _blocks(batch):
                    model = models[x.shape[1]]
                    k = len(model.values)
                    exact, centred = model.centred(x)
                    if exact.dtype != object and float(np.abs(exact).max(initial=0)) ** 2 * x.shape[1] >= 2.0**62:
                        exact = exact.astype(object)
                    deviation = np.array((exact * exact).sum(axis=1).tolist(), np.int64)
                    ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
                    columns = [ids, np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)), np.full(len(at) * k, model.n), np.repeat(deviation, k), model.whiten(centred).ravel(), np.tile(model.values / model.trace if k else model.values, len(at)), np.full(len(at) * k, errors[x.shape[1]])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened rows of the whole embeddings table."""
    return whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
