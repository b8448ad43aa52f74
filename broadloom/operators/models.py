"""Model families fitted and scored over distributed rows of (features array<float>, label)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from math import exp
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.operators.evaluation import average_precision, score_curve
from broadloom.operators.splits import class_weights
from broadloom.session import write_read

Scorer = Callable[[DataFrame], DataFrame]


def weighted(train: DataFrame) -> DataFrame:
    """Training rows with balanced class weights; two rows are broadcast."""
    return train.join(F.broadcast(class_weights(train)), "label")


def fit_logistic(train: DataFrame, alpha: float, iterations: int = 30) -> Scorer:
    """L2-penalised logistic regression with balanced weights; adds ``score``, the probability of label 1."""
    model = LogisticRegression(weightCol="weight", regParam=alpha, elasticNetParam=0.0, standardization=False, maxIter=iterations, featuresCol="_v").fit(weighted(train).withColumn("_v", array_to_vector(F.col("features").cast("array<double>"))))
    return lambda df: model.transform(df.withColumn("_v", array_to_vector(F.col("features").cast("array<double>")))).withColumn("score", F.element_at(vector_to_array("probability"), 2)).drop("_v", "rawPrediction", "probability", "prediction")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _init(sizes: list[int], seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [x for a, b in zip(sizes[:-1], sizes[1:], strict=True) for x in (rng.standard_normal((a, b)) * np.sqrt(2 / a), np.zeros(b))]


def forward(params: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """Layer outputs: ReLU inside, sigmoid at the end."""
    acts = [x]
    for k in range(0, len(params), 2):
        z = acts[-1] @ params[k] + params[k + 1]
        acts.append(1 / (1 + np.exp(-np.clip(z, -40, 40))) if k == len(params) - 2 else np.maximum(z, 0))
    return acts


def _gradient(params: list[np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    acts = forward(params, x)
    delta = (acts[-1] - target) * weight[:, None] / target.shape[1]
    out: list[np.ndarray] = []
    for k in range(len(params) - 2, -1, -2):
        out = [acts[k // 2].T @ delta, delta.sum(axis=0), *out]
        if k:
            delta = (delta @ params[k].T) * (acts[k // 2] > 0)
    return out


def _kept_share(keep: float, width: int, rows: np.ndarray, layer: int, epoch: int, seed: int) -> np.ndarray:
    """Dropout factors of some rows' units, 0 or 1/keep: a hash of row, unit, layer, epoch and seed, so the same on whatever task a row is."""
    u = np.uint64
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64)[:, None] * u(0x9E3779B97F4A7C15) + (np.arange(width, dtype=np.uint64) + u(width * layer + 1))[None, :] * u(0xBF58476D1CE4E5B9)
        x += u(epoch) * u(0x94D049BB133111EB) + u(seed)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> u(shift))) * u(times)
    return ((x ^ (x >> u(31))) >> u(11)).astype(np.float64) * 2.0**-53 < keep


def minibatch_gradient(params: list[np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray, rows: np.ndarray, dropout: float, epoch: int, seed: int) -> tuple[list[np.ndarray], float]:
    """The summed gradient of some rows with dropout after the inner layers, and their summed loss."""
    keep, acts, masks = 1.0 - dropout, [x], []
    last = len(params) - 2
    for k in range(0, len(params), 2):
        z = acts[-1] @ params[k] + params[k + 1]
        if k == last:
            acts.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
            continue
        masks.append(_kept_share(keep, z.shape[1], rows, k, epoch, seed) / keep if dropout else np.ones_like(z))
        acts.append(np.maximum(z, 0) * masks[-1])
    y = np.clip(acts[-1], 1e-12, 1 - 1e-12)
    loss = float((-(target * np.log(y) + (1 - target) * np.log(1 - y)).mean(axis=1) * weight).sum())
    delta = (acts[-1] - target) * weight[:, None] / target.shape[1]
    out: list[np.ndarray] = []
    for k in range(last, -1, -2):
        out = [acts[k // 2].T @ delta, delta.sum(axis=0), *out]
        if k:
            delta = (delta @ params[k].T) * (acts[k // 2] > 0) * masks[k // 2 - 1]
    return out, loss


class Adam:
    """Parameters, their moments, and the steps made."""

    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.first, self.second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def move(self, grads: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, m, v in zip(self.params, grads, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def _mixed(states: list[list[np.ndarray]], n: np.ndarray) -> list[np.ndarray]:
    """States of tasks averaged by their rows."""
    return [sum(w * x for w, x in zip(n / n.sum(), some, strict=True)) for some in zip(*states, strict=True)]


def _mix(table: pa.Table) -> pa.Table:
    """One state of several (state, n, loss), those of a group of tasks."""
    n = np.array(table.column("n").to_pylist(), np.float64)
    state = _mixed([pickle.loads(s) for s in table.column("state").to_pylist()], n)
    return pa.table({"state": pa.array([pickle.dumps(state)], pa.binary()), "n": [int(n.sum())], "loss": [float(sum(table.column("loss").to_pylist()))]})


def _pass(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> tuple[list[np.ndarray], int, float] | None:
    """One pass of ``run`` over the rows by tasks; the mixed state, its rows and loss, None if there are no rows."""
    kind = "state binary, n long, loss double"
    some = rows.mapInArrow(run, kind).groupBy(F.spark_partition_id() % 8).applyInArrow(_mix, kind).toArrow()
    if not some.num_rows:
        return None
    one = _mix(some)
    return pickle.loads(one.column("state")[0].as_py()), one.column("n")[0].as_py(), one.column("loss")[0].as_py()


def _epoch(rows: DataFrame, state: Adam, width: int, autoencoder: bool, batch_rows: int, dropout: float, epoch: int, seed: int) -> tuple[Adam, float]:
    """One epoch: every task makes minibatch steps over its rows from the state so far, and the states of tasks are mixed by their rows.

    A task holds one record batch. With one task these are the steps of a single machine.
    """
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adam: Adam = pickle.loads(shared.value)
        lost, seen = 0.0, 0
        for b in batches:
            order = np.random.default_rng([seed, epoch, seen]).permutation(b.num_rows) if seed else np.arange(b.num_rows)
            for i in range(0, b.num_rows, batch_rows):
                some = b.take(pa.array(order[i : i + batch_rows]))
                x = dense_rows(some, width)
                target = x if autoencoder else some.column("label").to_numpy().astype(np.float64)[:, None]
                grads, loss = minibatch_gradient(adam.params, x, target, some.column("weight").to_numpy(), some.column("row").to_numpy(), dropout, epoch, seed)
                adam.move([g / some.num_rows for g in grads])
                lost, seen = lost + loss, seen + some.num_rows
        if seen:
            yield pa.RecordBatch.from_pydict({"state": pa.array([pickle.dumps([*adam.params, *adam.first, *adam.second, np.array([adam.step])])], pa.binary()), "n": [seen], "loss": [lost]})

    got = _pass(rows, run)
    shared.unpersist()
    if got is None:
        return state, 0.0
    mixed, n, loss = got
    k = len(state.params)
    state.params, state.first, state.second, state.step = mixed[:k], mixed[k : 2 * k], mixed[2 * k : 3 * k], round(float(mixed[-1][0]))
    return state, loss / n


def dense_rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Features of a record batch as a matrix, from a column features or from sparse rows (indices, values)."""
    if "features" in batch.schema.names:
        return _matrix(batch.column("features"))
    out = np.zeros((batch.num_rows, width))
    lists = batch.column("indices")
    out[np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = batch.column("values").flatten().to_numpy()
    return out


def _train(rows: DataFrame, sizes: list[int], autoencoder: bool, epochs: int, rate: float, seed: int, batch_rows: int = 256, dropout: float = 0.0, validation: DataFrame | None = None) -> list[np.ndarray]:
    """Minibatch Adam over epochs; with ``validation`` the parameters of the epoch of greatest average precision there.

    Rows are stored once, with a number each. An epoch is a job of its own, from
    parameters that the driver holds, so a lost executor costs no more than its tasks.
    """
    features = ["features"] if "features" in rows.columns else ["indices", "values"]
    kept = write_read(rows.select(*features, F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight"), F.monotonically_increasing_id().alias("row")))
    state = Adam(_init(sizes, seed), rate)
    best: tuple[float, list[np.ndarray]] | None = None
    for epoch in range(epochs):
        state, _ = _epoch(kept, state, sizes[0], autoencoder, batch_rows, dropout, epoch, seed)
        if validation is not None:
            ap = average_precision(score_curve(_scorer(state.params, autoencoder)(validation).select("score", "label"))).first()[0] or 0.0
            if best is None or ap > best[0]:
                best = (ap, [p.copy() for p in state.params])
    return best[1] if best else state.params


#: Row widths up to which a step in plain numbers is cheaper than one in arrays.
NARROW = 64


class AveragedSGD:
    """Averaged stochastic gradient descent of the logistic loss for a grid of L2 penalties at once, row by row.

    The rate falls as 1 / (alpha * (t0 + t)), with t0 such that the first steps are no
    longer than weights typically are.
    """

    def __init__(self, alphas: tuple[float, ...], width: int):
        self.alphas = np.array(alphas, np.float64)
        self.weights, self.bias = np.zeros((len(alphas), width)), np.zeros(len(alphas))
        self.mean_weights, self.mean_bias = self.weights.copy(), self.bias.copy()
        typical = np.sqrt(1 / np.sqrt(self.alphas))
        first = typical / np.maximum(1.0, 1 / (1 + np.exp(-typical)))
        self.t0, self.t = 1 / (first * self.alphas), 0

    def step(self, index: np.ndarray, value: np.ndarray, label: int, weight: float) -> None:
        rate = 1 / (self.alphas * (self.t0 + self.t))
        margin = self.weights[:, index] @ value + self.bias
        slope = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label) * weight
        self.weights *= np.maximum(0.0, 1 - rate * self.alphas)[:, None]
        self.weights[:, index] -= (rate * slope)[:, None] * value
        self.bias -= rate * slope
        self.t += 1
        self.mean_weights += (self.weights - self.mean_weights) / self.t
        self.mean_bias += (self.bias - self.mean_bias) / self.t


    def steps(self, batch: pa.RecordBatch, order: np.ndarray) -> None:
        """A step for every row of a batch, in this order; narrow rows in plain numbers, penalty by penalty."""
        labels, weights = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
        width = self.weights.shape[1]
        if width > NARROW:
            listed = list(_sparse(batch))
            for i in order:
                self.step(*listed[i], labels[i], weights[i])
            return
        rows = list(zip(dense_rows(batch, width)[order].tolist(), labels[order].tolist(), weights[order].tolist(), strict=True))
        for k, alpha in enumerate(self.alphas.tolist()):
            t0, t, bias, mean_bias = float(self.t0[k]), self.t, float(self.bias[k]), float(self.mean_bias[k])
            own, mean = self.weights[k].tolist(), self.mean_weights[k].tolist()
            for x, label, weight in rows:
                rate = 1 / (alpha * (t0 + t))
                t += 1
                margin = min(max(sum(map(mul, own, x)) + bias, -40.0), 40.0)
                move = rate * (1 / (1 + exp(-margin)) - label) * weight
                keep = max(0.0, 1 - rate * alpha)
                own = [keep * a - move * v for a, v in zip(own, x)]
                bias -= move
                mean = [m + (a - m) / t for m, a in zip(mean, own)]
                mean_bias += (bias - mean_bias) / t
            self.weights[k], self.bias[k], self.mean_weights[k], self.mean_bias[k] = own, bias, mean, mean_bias
        self.t += len(rows)


def _sparse(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if "features" in batch.schema.names:
        for x in _matrix(batch.column("features")):
            at = np.flatnonzero(x)
            yield at, x[at]
        return
    lists = batch.column("indices")
    ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    index, value = lists.flatten().to_numpy(), batch.column("values").flatten().to_numpy().astype(np.float64)
    for i, j in zip(ends[:-1], ends[1:], strict=True):
        yield index[i:j], value[i:j]


def fit_sgd(train: DataFrame, width: int, alphas: tuple[float, ...] = (1e-4, 1e-3), epochs: int = 5, seed: int = 7) -> dict[float, Scorer]:
    """A scorer for each penalty, by iterative parameter mixing of averaged SGD with balanced class weights.

    In an epoch every task goes over its own rows, in an order that the seed and the
    epoch give, from the mixed state of the epoch before; states are averaged by their
    rows, in groups of tasks first. All penalties share the passes. Rows are sparse
    (indices, values) or dense (features); of sparse rows only the entries are touched.
    """
    features = ["features"] if "features" in train.columns else ["indices", "values"]
    rows = write_read(weighted(train).select(*features, F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight")))
    state = AveragedSGD(alphas, width)
    fields = ("weights", "bias", "mean_weights", "mean_bias")
    for epoch in range(epochs):
        shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(state))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, epoch=epoch) -> Iterator[pa.RecordBatch]:
            own, n = pickle.loads(shared.value), 0
            for b in batches:
                own.steps(b, np.random.default_rng([seed, epoch, n]).permutation(b.num_rows))
                n += b.num_rows
            if n:
                yield pa.RecordBatch.from_pydict({"state": pa.array([pickle.dumps([*(getattr(own, f) for f in fields), np.array([own.t])])], pa.binary()), "n": [n], "loss": [0.0]})

        got = _pass(rows, run)
        shared.unpersist()
        if got:
            *mixed, t = got[0]
            for f, x in zip(fields, mixed, strict=True):
                setattr(state, f, x)
            state.t = round(float(t[0]))
    return {a: _linear(state.mean_weights[k].copy(), float(state.mean_bias[k])) for k, a in enumerate(alphas)}


def _products(batch: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    """Each row's features times the weights."""
    if "features" in batch.schema.names:
        return _matrix(batch.column("features")) @ weights
    lists = batch.column("indices")
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
    return np.bincount(row, weights[lists.flatten().to_numpy()] * batch.column("values").flatten().to_numpy(), minlength=batch.num_rows)


def _linear(weights: np.ndarray, bias: float) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    z = _products(b, weights) + bias
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], [*b.schema.names, "score"])

        return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", score double")

    return score


def _scorer(params: list[np.ndarray], autoencoder: bool) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(params)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = dense_rows(b, len(shared.value[0]))
                y = forward(shared.value, x)[-1]
                if autoencoder:
                    y = np.clip(y, 1e-12, 1 - 1e-12)
                    out = -(x * np.log(y) + (1 - x) * np.log(1 - y)).mean(axis=1)
                else:
                    out = y[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "score"])

        return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", score double")

    return score


def fit_mlp(train: DataFrame, width: int, hidden: tuple[int, ...] = (16, 8), epochs: int = 10, rate: float = 0.01, seed: int = 7, batch_rows: int = 256, dropout: float = 0.1, validation: DataFrame | None = None) -> Scorer:
    """ReLU network with weighted cross-entropy and dropout; ``score`` is the probability of label 1."""
    return _scorer(_train(weighted(train), [width, *hidden, 1], False, epochs, rate, seed, batch_rows, dropout, validation), False)


def fit_autoencoder(train: DataFrame, width: int, hidden: tuple[int, ...] = (2,), epochs: int = 10, rate: float = 0.02, seed: int = 7, batch_rows: int = 256, validation: DataFrame | None = None) -> Scorer:
    """Fitted on label 0 alone, for features in [0, 1]; ``score`` is the mean cross-entropy of a row, larger is stranger."""
    return _scorer(_train(train.filter("label = 0").withColumn("weight", F.lit(1.0)), [width, *hidden, width], True, epochs, rate, seed, batch_rows, 0.0, validation), True)


#: Adapter name -> fit(train, **parameters) -> scorer.
ADAPTERS: dict[str, Callable[..., Scorer]] = {"logistic": fit_logistic, "mlp": fit_mlp, "autoencoder": fit_autoencoder}


def select_candidate(candidates: list[tuple[str, Scorer]], validation: DataFrame) -> tuple[str, Scorer, float]:
    """The candidate of greatest average precision on validation rows; the first wins ties."""
    best = None
    for name, scorer in candidates:
        ap = average_precision(score_curve(scorer(validation).select("score", "label"))).first()[0] or 0.0
        if best is None or ap > best[2]:
            best = (name, scorer, ap)
    if best is None:
        raise ValueError("no candidate")
    return best


def predict(df: DataFrame, scorer: Scorer, threshold: float, contract: dict[str, str]) -> DataFrame:
    """Scored rows with ``prediction``; rows of another dataset or config are an error."""
    wrong = F.lit(False)
    for c, v in contract.items():
        wrong |= ~F.coalesce(F.col(c) == v, F.lit(False))
    guard = F.assert_true(~wrong, F.lit("rows of another dataset or config"))
    checked = df.withColumn("_ok", guard).filter(F.col("_ok").isNull()).drop("_ok")
    return scorer(checked).withColumn("prediction", (F.col("score") >= threshold).cast("int"))
