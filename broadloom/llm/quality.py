"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed words.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector is shared by all
grades, the thresholds are ordered. Weights are fitted in tasks over parts of a
bounded sample of rated documents and averaged over a few rounds. Every document
then gets its expected grade and the probability of the top grade.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import sized_join, stored

BITS = 18
#: Bound of the sample: about so many ratings are fitted, however many there are.
MAX_FIT_ROWS = 24_000
PARTS, ROUNDS, EPOCHS, BATCH, RATE, DECAY = 6, 4, 3, 64, 0.5, 1e-6
#: Share of top-graded documents that selection keeps; the limit is calibrated on ratings that were not fitted.
KEEP_SHARE = 0.99
_CACHE_WORDS = 400_000


class Hasher:
    """Distinct lower-cased words of a text as feature numbers; remembers a bounded number of words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if not words:
            return np.empty(0, np.int32)
        known = self.known
        try:
            found = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        except KeyError:
            if len(known) > _CACHE_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = zlib.crc32(w.strip(".,;:!?\"'()|").encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
            found = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        return np.unique(found)


@dataclass
class Ordinal:
    """Weights, ordered thresholds, the grades they stand between, and the selection limit."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]
    limit: float = 0.5

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(f) for f in features], np.int64)
        flat = np.concatenate(features) if len(features) else np.empty(0, np.int32)
        sums = np.bincount(np.repeat(np.arange(len(features)), sizes), weights=self.weights[flat], minlength=len(features))
        return sums / np.sqrt(np.maximum(sizes, 1))

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade (rows x grades)."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))
        return np.diff(np.column_stack([np.zeros(len(scores)), below, np.ones(len(scores))]), axis=1)


def _descend(model: Ordinal, squares: np.ndarray, features: list[np.ndarray], at: np.ndarray, seed: int) -> int:
    """Passes of adaptive gradient steps over one part of the sample, in place. Returns the rows it saw."""
    rng = np.random.default_rng(seed)
    t_squares = np.full(len(model.thresholds), 1e-8)
    for _ in range(EPOCHS):
        order = rng.permutation(len(features))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            rows, y = [features[k] for k in some], at[some]
            sizes = np.array([len(f) for f in rows])
            below = 1 / (1 + np.exp(-np.clip(model.thresholds[None, :] - model.scores(rows)[:, None], -40, 40)))
            edge = np.column_stack([np.zeros(len(y)), below, np.ones(len(y))])
            low, high = edge[np.arange(len(y)), y], edge[np.arange(len(y)), y + 1]
            slope = 1 - low - high  # of the loss in the score
            flat = np.concatenate(rows)
            touched, where = np.unique(flat, return_inverse=True)
            g = np.bincount(where, weights=np.repeat(slope / np.sqrt(np.maximum(sizes, 1)), sizes)) / len(y) + DECAY * model.weights[touched]
            squares[touched] += g * g
            model.weights[touched] -= RATE * g / np.sqrt(squares[touched])
            p = np.maximum(high - low, 1e-9)
            t = np.zeros(len(model.thresholds))
            inner = y < len(t)
            np.add.at(t, y[inner], -(high * (1 - high) / p)[inner])
            np.add.at(t, y[y > 0] - 1, (low * (1 - low) / p)[y > 0])
            t /= len(y)
            t_squares += t * t
            model.thresholds -= 0.1 * t / np.sqrt(t_squares)
            model.thresholds = np.maximum.accumulate(model.thresholds + np.arange(len(t)) * 1e-6)
    return len(features)


def _step(shared, number: int):
    """One round on one part: the part's rows, and its weights, thresholds and step sizes after its passes."""

    def step(table: pa.Table) -> pa.Table:
        own, squares = pickle.loads(shared.value)
        index = {g: i for i, g in enumerate(own.grades)}
        features = [np.asarray(f, np.int32) for f in table.column("features").to_pylist()]
        at = np.array([index[g] for g in table.column("grade").to_pylist()])
        order = np.lexsort((at, [zlib.crc32(f.tobytes()) for f in features]))  # the same whatever order rows come in
        n = _descend(own, squares, [features[i] for i in order], at[order], number)
        return pa.table({"n": [n], "model": [pickle.dumps((own.weights.astype(np.float32), own.thresholds, squares.astype(np.float32)))]})

    return step


def rated_sample(docs: DataFrame, ratings: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(grade, check, features) of a bounded sample of ratings: those of smallest id hash, one in five for calibration.

    ``docs`` (doc_id, text), ``ratings`` (doc_id, grade); null ids or grades are left
    out, several ratings of a document all count.
    """
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    rated = ratings.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).select("doc_id", "grade", u.alias("u"))
    n = max(rated.count(), 1)
    few = stored(rated.filter(F.col("u") * n < max_fit_rows))  # about max_fit_rows rows; more where one document has many ratings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            features = [hasher(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("grade"), b.column("part"), pa.array(features, pa.list_(pa.int32()))], ["grade", "part", "features"])

    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5 * PARTS)).cast("int")
    return sized_join(docs, few, ["doc_id"], "inner").select("grade", part.alias("part"), "text").mapInArrow(run, "grade int, part int, features array<int>")


def fit(docs: DataFrame, ratings: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Ordinal:
    """The model of (doc_id, text) and (doc_id, grade); fewer than two grades give a model that tells nothing apart."""
    spark = docs.sparkSession
    sample = stored(rated_sample(docs, ratings, max_fit_rows))
    counts = {r["grade"]: r["n"] for r in sample.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    grades = sorted(counts)
    if len(grades) < 2:
        return Ordinal(np.zeros(1 << BITS, np.float32), np.zeros(max(len(grades) - 1, 0)), grades or [0], 0.0)
    share = np.cumsum([counts[g] for g in grades])[:-1] / sum(counts.values())
    model = Ordinal(np.zeros(1 << BITS), np.log(share / (1 - share)), grades)
    squares = np.full(1 << BITS, 1e-8)
    fitted = sample.filter(F.col("part") % 5 != 0).select("grade", "part", "features")
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(pickle.dumps((model, squares)))

        # PARTS groups of a bounded sample
        got = fitted.groupBy(F.col("part") % PARTS).applyInArrow(_step(shared, number), "n long, model binary").collect()
        total = sum(r["n"] for r in got)
        parts = [(r["n"] / total, *pickle.loads(r["model"])) for r in sorted(got, key=lambda r: (r["n"], bytes(r["model"])[:64]))]
        model.weights = sum(p * w.astype(np.float64) for p, w, _, _ in parts)
        model.thresholds = sum(p * t for p, _, t, _ in parts)
        squares = sum(p * s.astype(np.float64) for p, _, _, s in parts)
        shared.unpersist()
    top = sample.filter((F.col("part") % 5 == 0) & (F.col("grade") == grades[-1])).select("features").limit(max_fit_rows).toArrow()
    tails = model.probabilities(model.scores([np.asarray(f, np.int32) for f in top.column("features").to_pylist()]))[:, -1]
    model.limit = float(min(0.5, np.quantile(tails, 1 - KEEP_SHARE))) if len(tails) else 0.5
    model.weights = model.weights.astype(np.float32)
    return model


def grade_documents(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, expected_grade, p_top, grade, kept of every row of (doc_id, text).

    p_top is the probability of the top grade, grade the most probable one, kept
    whether p_top reaches the calibrated limit. Null and empty texts have no
    features; they get the probabilities of the thresholds alone. Repeated rows
    each give a row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher = pickle.loads(shared.value), Hasher()
        grades = np.array(own.grades, np.int32)
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                p = own.probabilities(own.scores([hasher(t.as_py()) for t in part.column("text")]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p @ grades), pa.array(p[:, -1]), pa.array(grades[p.argmax(axis=1)]), pa.array(p[:, -1] >= own.limit)], ["doc_id", "expected_grade", "p_top", "grade", "kept"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, expected_grade double, p_top double, grade int, kept boolean")


def ratings_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic marks: toxic 0, poor 1, good 2; null marks give null."""
    grade = F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & (F.col("quality") == 0), 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """Fits on rated documents and grades every document; see ``grade_documents``. Other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return grade_documents(rows, fit(rows, ratings_of(labels), max_fit_rows))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of the whole documents table, from the labels table."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
