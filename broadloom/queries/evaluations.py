"""Metrics, model fits and predictions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.operators import evaluation as E
from broadloom.operators import models as M
from broadloom.operators.splits import split_hash, vector
from broadloom.queries.features import _SPLIT, SEED
from broadloom.session import write_read
from broadloom.sources.views import FEATURES, SAMPLES_SQL, SCORES_SQL, samples, scores

_CURVE = SCORES_SQL + """, g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scores GROUP BY 1),
c AS (SELECT score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp FROM g)"""


def score_curve(spark, sf_dir):
    return E.score_curve(scores(spark, sf_dir)).select("score", "pos", "neg", "tp", "fp")


def avg_precision(spark, sf_dir):
    return E.average_precision(E.score_curve(scores(spark, sf_dir))).select(F.round("average_precision", 9).alias("average_precision"))


def roc_auc(spark, sf_dir):
    return E.roc_auc(E.score_curve(scores(spark, sf_dir))).select(F.round("roc_auc", 9).alias("roc_auc"))


def f1_threshold(spark, sf_dir):
    return E.f1_threshold(E.score_curve(scores(spark, sf_dir))).select("threshold", F.round("f1", 9).alias("f1"))


def _rounded(df, by=()):
    real = ["prevalence", "precision", "recall", "f1", "balanced_accuracy", "fpr"]
    return df.select(*by, "n_rows", "tn", "fp", "fn", "tp", *[F.round(c, 9).alias(c) for c in real])


def confusion_metrics(spark, sf_dir):
    return _rounded(E.confusion(scores(spark, sf_dir), 0.3))


def metrics_by_year(spark, sf_dir):
    rows = samples(spark, sf_dir).select((F.col("feat_0") / (F.col("vt_count") + 1)).alias("score"), "label", F.substring("year_month", 1, 4).alias("year"))
    curve = E.score_curve(rows, by=["year"])
    return _rounded(E.confusion(rows, 0.3, by=["year"]), ["year"]).join(E.roc_auc(curve, ["year"]).withColumn("roc_auc", F.round("roc_auc", 9)), "year")


def test_at_half(spark, sf_dir):
    return _rounded(E.confusion(scores(spark, sf_dir), 0.5))


def log_loss(spark, sf_dir):
    return E.log_loss(scores(spark, sf_dir)).select(F.round("log_loss", 9).alias("log_loss"))


def prior_baseline(spark, sf_dir):
    """The training prevalence as every test row's score, at one half."""
    rows = samples(spark, sf_dir)
    prior = rows.filter("split_name = 'train'").agg(F.avg("label").alias("score"))
    test = rows.filter("split_name = 'test'").crossJoin(F.broadcast(prior)).select("label", "score")  # one row
    return _rounded(E.confusion(test, 0.5)).join(E.log_loss(test).select(F.round("log_loss", 9).alias("log_loss")))


def _model_rows(spark, sf_dir):
    """Samples with a split, counts of some kinds of lines in [0, 1], and whether the order has five lines or more, which no count tells by itself."""
    rows = samples(spark, sf_dir).withColumn("split", split_hash(F.col("split_name"), F.col("hash"), SEED))
    part = [F.least(F.col(c) / 7.0, F.lit(1.0)).alias(c) for c in FEATURES]
    large = (F.col("vt_count") >= 5).cast("int").alias("label")
    df = rows.select("hash", "dataset_id", "config_name", "split", large, *part)
    return write_read(df.withColumn("features", vector(FEATURES)).select("hash", "dataset_id", "config_name", "split", "label", "features"))


def _quality(scored):
    """Rows and positives scored, scores out of range, and whether average precision and AUC beat chance; one curve gives both."""
    curve = E.score_curve(scored.select("score", "label"))
    n = curve.agg((F.sum("pos") + F.sum("neg")).alias("n_rows"), F.sum("pos").alias("positives"), F.count_if(F.isnan("score") | (F.col("score") < 0)).alias("out_of_range"))
    both = n.join(E.average_precision(curve)).join(E.roc_auc(curve))  # one row each
    return both.select("n_rows", "positives", "out_of_range", (F.col("average_precision") > 1.2 * F.col("positives") / F.col("n_rows")).alias("ranks"), (F.col("roc_auc") > 0.6).alias("separates"))


def _fit(name, **kwargs):
    def query(spark, sf_dir):
        rows = _model_rows(spark, sf_dir)
        return _quality(M.ADAPTERS[name](rows.filter("split = 'train'"), **kwargs)(rows.filter("split = 'test'")))

    return query


def fit_logistic(spark, sf_dir):
    """Averaged SGD over a grid of penalties; the one of greatest average precision on validation rows scores the test."""
    rows = _model_rows(spark, sf_dir)
    fitted = M.fit_sgd(rows.filter("split = 'train'"), len(FEATURES))
    _, scorer, _ = M.select_candidate([(f"alpha={a}", s) for a, s in fitted.items()], rows.filter("split = 'validation'"))
    return _quality(scorer(rows.filter("split = 'test'")))


def score_rows(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    scored = M.fit_logistic(rows.filter("split = 'train'"), 1e-3)(rows)
    return scored.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("score").between(0, 1)).alias("out_of_range"))


def select_candidate(spark, sf_dir):
    """Two fitted candidates and one that scores everything alike, which must not win."""
    rows = _model_rows(spark, sf_dir)
    train = rows.filter("split = 'train'")
    flat = lambda df: df.withColumn("score", F.lit(0.5))
    fitted = [(f"alpha={a}", M.fit_logistic(train, a)) for a in (1e-4, 1e-3)]
    name, scorer, _ = M.select_candidate([("flat", flat), *fitted], rows.filter("split = 'validation'"))
    return _quality(scorer(rows.filter("split = 'test'"))).withColumn("fitted_won", F.lit(name.startswith("alpha=")))


def predict(spark, sf_dir):
    rows = _model_rows(spark, sf_dir).filter("config_name = 'wide'")
    scorer = M.fit_logistic(rows.filter("split = 'train'"), 1e-3)
    return M.predict(rows.filter("split = 'test'"), scorer, 0.5, {"dataset_id": "orders", "config_name": "wide"}).select(
        "hash", F.col("score").between(0, 1).alias("probability"), (F.col("prediction") == (F.col("score") >= 0.5).cast("int")).alias("thresholded")
    )


QUERIES = {f.__name__: f for f in [score_curve, avg_precision, roc_auc, f1_threshold, confusion_metrics, metrics_by_year, test_at_half, log_loss, prior_baseline, fit_logistic, score_rows, select_candidate, predict]} | {
    "fit_mlp": _fit("mlp", width=len(FEATURES)), "fit_autoencoder": _fit("autoencoder", width=len(FEATURES)),
}


def _confusion(source: str, t: float, by: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""n AS (SELECT {g}count(*) AS n_rows, avg(label) AS prevalence, count(*) FILTER (score < {t} AND label = 0) AS tn, count(*) FILTER (score >= {t} AND label = 0) AS fp, count(*) FILTER (score < {t} AND label = 1) AS fn, count(*) FILTER (score >= {t} AND label = 1) AS tp FROM {source} {'GROUP BY ' + by if by else ''}),
m AS (SELECT {g}n_rows, tn, fp, fn, tp, round(prevalence, 9) AS prevalence, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, round((tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2, 9) AS balanced_accuracy, round(1 - tn / nullif(tn + fp, 0), 9) AS fpr FROM n)"""


_LL = "round(-avg(CASE WHEN label = 1 THEN ln(greatest(least(score, 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END), 9)"
_FIT = f"WITH {SAMPLES_SQL}, t AS (SELECT *, {_SPLIT} AS split FROM samples) SELECT count(*) AS n_rows, CAST(sum(CAST(vt_count >= 5 AS INTEGER)) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS out_of_range, true AS ranks, true AS separates FROM t WHERE split = 'test'"
_YEAR = f"{SAMPLES_SQL}, y AS (SELECT feat_0 / (vt_count + 1) AS score, label, substr(year_month, 1, 4) AS year FROM samples)"

SQL = {
    "score_curve": f"WITH {_CURVE} SELECT * FROM c",
    "avg_precision": f"WITH {_CURVE} SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 9) AS average_precision FROM c",
    "roc_auc": f"WITH {_CURVE} SELECT round(sum(neg * (tp - pos * 0.5)) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM c",
    "f1_threshold": f"WITH {_CURVE}, f AS (SELECT score, 2 * tp / (tp + fp + sum(pos) OVER ()) AS f1 FROM c) SELECT score AS threshold, round(f1, 9) AS f1 FROM f ORDER BY f.f1 DESC, score DESC LIMIT 1",
    "confusion_metrics": f"WITH {SCORES_SQL}, {_confusion('scores', 0.3)} SELECT * FROM m",
    "test_at_half": f"WITH {SCORES_SQL}, {_confusion('scores', 0.5)} SELECT * FROM m",
    "log_loss": f"WITH {SCORES_SQL} SELECT {_LL} AS log_loss FROM scores",
    "metrics_by_year": f"WITH {_YEAR}, {_confusion('y', 0.3, 'year')}, g AS (SELECT year, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM y GROUP BY 1, 2), c AS (SELECT *, sum(pos) OVER (PARTITION BY year ORDER BY score DESC) AS tp FROM g), a AS (SELECT year, round(sum(neg * (tp - pos * 0.5)) / nullif(sum(pos) * sum(neg), 0), 9) AS roc_auc FROM c GROUP BY 1) SELECT * FROM m JOIN a USING (year)",
    "prior_baseline": f"WITH {SAMPLES_SQL}, t AS (SELECT label, (SELECT avg(label) FROM samples WHERE split_name = 'train') AS score FROM samples WHERE split_name = 'test'), {_confusion('t', 0.5)} SELECT *, (SELECT {_LL} FROM t) AS log_loss FROM m",
    "fit_logistic": _FIT, "fit_mlp": _FIT, "fit_autoencoder": _FIT,
    "select_candidate": _FIT.replace(" FROM t", ", true AS fitted_won FROM t"),
    "predict": f"WITH {SAMPLES_SQL}, t AS (SELECT *, {_SPLIT} AS split FROM samples) SELECT hash, true AS probability, true AS thresholded FROM t WHERE split = 'test' AND config_name = 'wide'",
    "score_rows": f"WITH {SAMPLES_SQL} SELECT {_SPLIT} AS split, count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_range FROM samples GROUP BY 1",
}
