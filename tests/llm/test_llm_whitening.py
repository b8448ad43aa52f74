"""Whitening against numpy's eigenvectors, exact integers, and edge tables."""

import math
import time

import numpy as np
import pytest

from broadloom.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(5, 5), (40, 17), (200, 64), (30, 31)])
def test_cholesky_and_jacobi_equal_eigenvectors(shape):
    rng = np.random.default_rng(shape[0])
    x = rng.standard_normal(shape) * np.logspace(0, -4, shape[1]) @ rng.standard_normal((shape[1], shape[1]))
    a = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    factor, order = W.pivoted_cholesky(a)
    assert np.abs(factor @ factor.T - a[np.ix_(order, order)]).max() <= 1e-12 * np.abs(a).max()
    assert np.all(np.triu(factor, 1) == 0) and np.all(np.diff(np.diag(factor)) <= 1e-12)
    model = W.fit_components(shape[0], np.zeros(shape[1], np.int64), a, shape[1])
    want = np.linalg.eigvalsh(a / shape[0])[::-1]
    rank = min(shape[0] - 1, shape[1])
    assert len(model.values) <= rank
    kept = want[: len(model.values)]
    assert np.abs(model.values - kept).max() <= 1e-12 * want[0]
    assert np.abs(model.components.T @ model.components - np.eye(len(kept))).max() < 1e-12
    big = kept > 1e-6 * want[0]
    assert np.abs(a / shape[0] @ model.components - model.components * model.values)[:, big].max() <= 1e-12 * want[0]


def brute(rows, components=32):
    kept = [(i, e) for i, e, _ in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e] for _, e in kept]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    exact = [[n * c - s for c, s in zip(row, sums)] for row in x]
    z = np.array([[c / n for c in row] for row in exact])
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    return {i: sum(c * c for c in row) for (i, _), row in zip(kept, exact)}, z, values[::-1], vectors[:, ::-1], cov


def test_query_against_brute_force(spark, sf_dir):
    from broadloom.llm.registry import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    deviation, z, values, vectors, cov = brute(rows)
    got = QUERIES["op13_whitening"](spark, sf_dir).toPandas()
    assert len(got) == len(deviation) * 32 and set(got.n) == {len(deviation)}
    assert got.groupby("vec_id").deviation.first().to_dict() == deviation
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error[0] <= 1e-4
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.abs(explained / (values[:32] / np.trace(cov)) - 1).max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i in deviation]].to_numpy()
    want = z @ vectors[:, :32] / np.sqrt(values[:32])
    want *= np.sign((want * wide).sum(axis=0))
    gap = np.minimum(np.abs(np.diff(values))[:32], np.append(np.inf, np.abs(np.diff(values))[:31])) > 1e-6 * values[0]
    assert np.abs(wide - want)[:, gap].max() < 1e-6
    measured = np.cov(wide.T, bias=True)
    assert np.abs(measured - np.eye(32)).max() < 1e-9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0], 0), (2, [1.5, -2.0, 0.25], None), (2, [1.5, -2.0, 0.25], None), (None, [0.0, 0.0, 9.0], 1)]
    bad = [(4, None, 0), (5, [], 0), (6, [1.0, None, 2.0], 0), (7, [nan, 1.0, 1.0], 0), (8, [inf, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows + bad, VECTORS).selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS size")
    got = W.whitening(df).toPandas()
    # three different points span a plane: two components
    assert sorted(got.component) == [1, 1, 1, 1, 2, 2, 2, 2] and set(got.n) == {4} and got.vec_id.isna().sum() == 2
    assert got.identity_error.max() < 1e-9 and abs(got.groupby("component").explained.first().sum() - 1) < 1e-9
    assert W.whitening(spark.createDataFrame([], VECTORS)).collect() == []
    assert W.whitening(spark.createDataFrame(bad, VECTORS)).collect() == []
    assert W.whitening(spark.createDataFrame([rows[0]] * 5, VECTORS)).collect() == []
    # lengths are fits of their own
    mixed = W.whitening(spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [0.0, 0.0], 0), (4, [2.0, 2.0], 0), (5, [4.0, 4.0], 0)], VECTORS)).toPandas()
    assert mixed.groupby("vec_id").n.first().to_dict() == {1: 2, 2: 2, 3: 3, 4: 3, 5: 3}
    assert mixed.set_index("vec_id").whitened.abs().round(9).to_dict() == {1: 1, 2: 1, 3: round(math.sqrt(1.5), 9), 4: 0, 5: round(math.sqrt(1.5), 9)}


def test_deviation_beyond_64_bits_is_exact_or_an_error(spark):
    df = spark.createDataFrame([(1, [2.0**30], 0), (2, [0.0], 0)], VECTORS)
    with pytest.raises(Exception, match="Overflow|too large|too big"):
        W.whitening(df).collect()
    got = W.whitening(spark.createDataFrame([(1, [2.0**24], 0), (2, [0.0], 0)], VECTORS)).collect()
    assert {r.deviation for r in got} == {2**60}


def test_wide_factor_is_fast():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 384))
    start = time.monotonic()
    model = W.fit_components(600, np.zeros(384, np.int64), x.T @ x)
    assert time.monotonic() - start < 60 and len(model.values) == 32
