"""Models: slopes against finite differences, scores that rank, and features that are scores of models."""

import pickle
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadloom.operators import evaluation as E
from broadloom.operators import models as M
from broadloom.plans import feature_plan as G
from broadloom.streaming import events as S


def loss(params, x, target, weight):
    y = np.clip(M.forward(params, x)[-1], 1e-12, 1 - 1e-12)
    return float((-(target * np.log(y) + (1 - target) * np.log(1 - y)).mean(axis=1) * weight).sum())


@pytest.mark.parametrize(("sizes", "autoencoder", "dropout"), [([4, 5, 3, 1], False, 0.0), ([4, 2, 4], True, 0.0), ([4, 6, 5, 1], False, 0.4)])
def test_gradients_equal_finite_differences(sizes, autoencoder, dropout):
    rng = np.random.default_rng(2)
    x, weight, ids = rng.random((20, 4)), rng.random(20), np.arange(20) * 7
    target = x if autoencoder else rng.integers(0, 2, (20, 1)).astype(float)
    params = [p + 0.05 * rng.standard_normal(p.shape) for p in M._init(sizes, 3)]
    loss_of = lambda: M.minibatch_gradient(params, x, target, weight, ids, dropout, 1, 5)[1]
    got = M.minibatch_gradient(params, x, target, weight, ids, dropout, 1, 5)[0]
    if not dropout:
        assert loss_of() == pytest.approx(loss(params, x, target, weight))
    for p, g in zip(params, got, strict=True):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(6)]:
            keep = p[at]
            p[at] = keep + 1e-6
            up = loss_of()
            p[at] = keep - 1e-6
            down = loss_of()
            p[at] = keep
            assert (up - down) / 2e-6 == pytest.approx(g[at], rel=1e-3, abs=1e-6)


def test_dropout_depends_on_the_row_alone():
    ids = np.arange(5000)
    mask = M._kept_share(0.7, 16, ids, 2, 3, 11)
    assert (M._kept_share(0.7, 16, ids[::-7], 2, 3, 11) == mask[::-7]).all() and abs(mask.mean() - 0.7) < 0.01 and (abs(mask.mean(axis=0) - 0.7) < 0.05).all()
    assert all((M._kept_share(0.7, 16, ids, *other) != mask).mean() > 0.3 for other in ((2, 4, 11), (0, 3, 11), (2, 3, 12)))


@pytest.mark.parametrize("layout", ["dense", "sparse"])
def test_mixed_minibatches_equal_numpy(spark, layout):
    rng = np.random.default_rng(8)
    x = rng.random((53, 6)) * (rng.random((53, 6)) < 0.5)
    x = x.astype(np.float32).astype(np.float64)
    label = rng.integers(0, 2, 53)
    if layout == "dense":
        df = spark.createDataFrame([(k, [float(v) for v in r], int(y), 1.0 + int(y)) for k, (r, y) in enumerate(zip(x, label))], "row long, features array<float>, label int, weight double")
    else:
        df = spark.createDataFrame([(k, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist(), int(y), 1.0 + int(y)) for k, (r, y) in enumerate(zip(x, label))], "row long, indices array<int>, values array<float>, label int, weight double")
    parts = df.repartitionByRange(2, "row").sortWithinPartitions("row")
    split = [[r.row for r in p] for p in parts.select("row").rdd.glom().collect()]
    assert len(split) == 2 and min(map(len, split)) > 10
    state, losses = M.Adam(M._init([6, 4, 3, 1], 1), 0.05), []
    want, k = M.Adam(M._init([6, 4, 3, 1], 1), 0.05), 6
    for epoch in range(3):
        state, got = M._epoch(parts, state, 6, False, 5, 0.3, epoch, 0)  # seed 0: rows in order
        total, ends = 0.0, []
        for part in split:
            mine = pickle.loads(pickle.dumps(want))
            for i in range(0, len(part), 5):
                at = np.array(part[i : i + 5])
                g, lost = M.minibatch_gradient(mine.params, x[at], label[at, None].astype(float), 1.0 + label[at], at, 0.3, epoch, 0)
                mine.move([p / len(at) for p in g])
                total += lost
            ends.append([*mine.params, *mine.first, *mine.second, np.array([mine.step])])
        mixed = M._mixed(ends, np.array([len(p) for p in split], float))
        want.params, want.first, want.second, want.step = mixed[:k], mixed[k : 2 * k], mixed[2 * k : 3 * k], round(float(mixed[-1][0]))
        losses.append((got, total / 53))
    assert all(a == pytest.approx(b, rel=1e-9) for a, b in losses)
    assert all(np.allclose(a, b, rtol=1e-8) for a, b in zip(state.params, want.params))


def test_averaged_sgd_is_as_good_as_on_one_machine(spark):
    rng = np.random.default_rng(4)
    n, width = 1500, 40
    x = (rng.random((n, width)) < 0.2) * rng.random((n, width))
    label = (x @ rng.standard_normal(width) * 3 + 0.3 * rng.standard_normal(n) > 0.4).astype(int)
    listed = [(k, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist(), int(y)) for k, (r, y) in enumerate(zip(x, label))]
    df = spark.createDataFrame(listed, "id long, indices array<int>, values array<float>, label int").repartition(4)
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    fitted = M.fit_sgd(train, width, (1e-4, 1e-3), epochs=5)
    one = M.AveragedSGD((1e-4, 1e-3), width)
    at = np.flatnonzero(np.arange(n) % 3 > 0)
    weight = len(at) / (2 * np.bincount(label[at]))
    for _ in range(5):
        for k in rng.permutation(at):
            one.step(np.array(listed[k][1], int), np.array(listed[k][2]), label[k], weight[label[k]])
    for k, scorer in enumerate(fitted.values()):
        mixed = E.average_precision(E.score_curve(scorer(test).select("score", "label"))).first()[0]
        alone = E.average_precision(E.score_curve(M._linear(one.mean_weights[k], one.mean_bias[k])(test).select("score", "label"))).first()[0]
        assert mixed > alone - 0.01 and mixed > 0.9, (mixed, alone)


@pytest.mark.parametrize("layout", ["dense", "sparse"])
def test_narrow_steps_equal_steps_in_arrays_and_cost_less(layout):
    rng = np.random.default_rng(6)
    n = 20_000
    x = ((rng.random((n, 3)) < 0.6) * rng.random((n, 3))).astype(np.float32)
    listed = [np.flatnonzero(r) for r in x]
    columns = {"features": pa.array(x.tolist(), pa.list_(pa.float32()))} if layout == "dense" else {"indices": pa.array([i.tolist() for i in listed], pa.list_(pa.int32())), "values": pa.array([r[i].tolist() for r, i in zip(x, listed)], pa.list_(pa.float32()))}
    batch = pa.RecordBatch.from_pydict(columns | {"label": rng.integers(0, 2, n), "weight": 0.5 + rng.random(n)})
    order = rng.permutation(n)
    one, other = M.AveragedSGD((1e-4, 1e-3), 3), M.AveragedSGD((1e-4, 1e-3), 3)
    began = time.process_time()
    one.steps(batch, order)
    narrow = time.process_time() - began
    began = time.process_time()
    for i in order:
        other.step(listed[i], x[i, listed[i]].astype(float), batch.column("label")[int(i)].as_py(), batch.column("weight")[int(i)].as_py())
    assert narrow < (time.process_time() - began) / 3 and one.t == other.t == n
    assert all(np.allclose(getattr(one, f), getattr(other, f), rtol=1e-6, atol=1e-9) for f in ("weights", "bias", "mean_weights", "mean_bias"))
    weights = rng.random(3)
    assert np.allclose(M._products(batch, weights), x.astype(float) @ weights)


def test_the_best_epoch_on_validation_is_kept(rows):
    every = [M.fit_mlp(rows.filter("id % 3 = 1"), 3, (4,), epochs=n, rate=0.3, validation=rows.filter("id % 3 = 2")) for n in (1, 4)]
    ap = [E.average_precision(E.score_curve(s(rows.filter("id % 3 = 2")).select("score", "label"))).first()[0] for s in every]
    assert ap[1] >= ap[0]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.random((600, 3))
    label = (x[:, 0] + 0.1 * rng.standard_normal(600) > 0.6).astype(int)
    return spark.createDataFrame([(i, [float(v) for v in a], int(b)) for i, (a, b) in enumerate(zip(x, label, strict=True))], "id long, features array<float>, label int")


@pytest.mark.parametrize(("name", "kwargs"), [("logistic", {"alpha": 1e-3}), ("mlp", {"width": 3, "epochs": 25, "batch_rows": 64})])
def test_fits_rank_rows_that_were_not_fitted(rows, name, kwargs):
    scored = M.ADAPTERS[name](rows.filter("id % 3 > 0"), **kwargs)(rows.filter("id % 3 = 0"))
    assert scored.count() == 200 and scored.filter(~F.col("score").between(0, 1)).isEmpty()
    assert E.roc_auc(E.score_curve(scored)).first()[0] > 0.9


def test_autoencoder_finds_strange_rows(spark):
    usual = [(i, [1.0, 1.0, 0.0, 0.9], 0) for i in range(200)]
    strange = [(1000 + i, [0.0, 0.0, 1.0, 0.1], 1) for i in range(40)]
    df = spark.createDataFrame(usual + strange, "id long, features array<float>, label int")
    scored = M.fit_autoencoder(df, width=4, epochs=40, batch_rows=64, rate=0.05)(df)
    assert scored.count() == 240 and E.roc_auc(E.score_curve(scored)).first()[0] > 0.95


def test_the_first_of_equal_candidates_wins(rows):
    good, flat = (lambda df: df.withColumn("score", F.element_at("features", 1).cast("double"))), (lambda df: df.withColumn("score", F.lit(0.5)))
    assert M.select_candidate([("flat", flat), ("a", good), ("b", good)], rows)[0] == "a"
    with pytest.raises(ValueError):
        M.select_candidate([], rows)


def test_predictions_refuse_other_contracts(spark):
    df = spark.createDataFrame([(1, "d", 0.7), (2, "d", 0.2)], "id int, dataset_id string, x double").coalesce(1)
    scorer = lambda d: d.withColumn("score", F.col("x"))
    assert [r.prediction for r in M.predict(df, scorer, 0.5, {"dataset_id": "d"}).collect()] == [1, 0]
    with pytest.raises(Exception, match="another dataset"):
        M.predict(df, scorer, 0.5, {"dataset_id": "e"}).collect()


def test_model_features_and_equivalence(spark):
    ref = "risk@1"
    if ref not in G.MODELS:
        G.register_model(ref, lambda x: 1 / (1 + F.exp(-x)))
    with pytest.raises(ValueError):
        G.register_model(ref, lambda x: x)
    with pytest.raises(ValueError):
        G.FeaturePlan.compile([G.Node("a@1", column="x", source="s"), G.Node("m@1", input="a@1", op="model", params={"model_ref": "none@1"})], ["m@1"])
    df = spark.createDataFrame([(0.0,), (2.0,), (None,)], "x double").coalesce(1)
    plan = G.FeaturePlan.compile([G.Node("a@1", column="x", source="s", type="double"), G.Node("m@1", input="a@1", op="model", params={"model_ref": ref}, type="double")], ["m@1"])
    assert [r[0] for r in plan.apply(df, []).collect()] == [0.5, pytest.approx(0.8807970779778823), None]
    same, off = (lambda x, p: F.exp(x) / (1 + F.exp(x))), (lambda x, p: F.exp(x) / (1 + F.exp(x)) + 1e-6)
    assert G.not_equivalent(df, "model", {"model_ref": ref}, "x", same).isEmpty() and G.not_equivalent(df, "model", {"model_ref": ref}, "x", off).count() == 2
    assert G.not_equivalent(df, "positive_presence", {}, "x", lambda x, p: (x >= 0).cast("int")).count() == 1


def test_trailing_sums_of_arrays():
    at, value = np.array([0, 1, 1, 5, 9, 10]), np.array([1, 2, 4, 8, 16, 32])
    assert S._sums(at, value, 5).tolist() == [int(value[(at >= t - 5) & (at < t)].sum()) for t in at]


def test_trailing_stream_drops_idle_devices_and_late_events(spark, tmp_path):
    S.rocksdb_state(spark)
    hour, t = 3600, 10**9
    batches = [[("a", 1, t, 1), ("a", 2, t + 10, 2), ("b", 3, t + 5, 7)], [("a", 4, t + 20 * hour, 5)], [("a", 6, t + 20 * hour + 5, 9)], [("a", 7, t + 20 * hour + 6, 1), ("b", 5, t + 6, 100)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "device string, event_id long, s long, value long").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    import os

    for k in range(len(batches)):  # batches are read by age
        for name in os.listdir(f"{tmp_path}/in/{k}"):
            os.utime(f"{tmp_path}/in/{k}/{name}", (1_700_000_000 + 100 * k,) * 2)
    stream = spark.readStream.schema("device string, event_id long, s long, value long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    rows = stream.select(F.when(F.col("device") == "a", 1).otherwise(2).cast("long").alias("device_id"), "event_id", F.timestamp_seconds("s").alias("event_time"), "value")
    got = {r.event_id: r.total for r in S.drain(S.trailing_stream(rows, 3600 * 1_000_000, 3600 * 1_000_000), "update", ["device_id", "event_id"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0, 6: 5, 7: 14}  # event 5 came after the watermark had passed it
