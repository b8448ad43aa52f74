"""Metrics that are exact under ties, from one score-grouped curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.session import write_read


def score_curve(df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None, parts: int = 64) -> DataFrame:
    """Distinct scores, descending, with cumulative tp and fp per group of ``by``.

    Rows are first reduced to distinct scores, which are stored. The running sum has two
    levels: scores are dealt to ``parts`` ranges that hold about as many distinct scores
    each, summed inside a range in order, and shifted by the totals of the ranges above,
    so no task holds a whole curve, however scores crowd.
    """
    by = by or []
    grouped = write_read(df.groupBy(*by, F.col(score).alias("score")).agg(F.sum(label).alias("pos"), (F.count(F.lit(1)) - F.sum(label)).alias("neg")))
    cuts = grouped.groupBy(*by).agg(F.percentile_approx("score", [k / parts for k in range(1, parts)]).alias("_cuts"))
    joined = grouped.join(F.broadcast(cuts), by) if by else grouped.crossJoin(F.broadcast(cuts))  # one row for each group of by
    above_it = F.filter(F.array_distinct("_cuts"), lambda q: q > F.col("score"))
    dealt = joined.withColumn("_part", F.coalesce(F.size(above_it), F.lit(0))).drop("_cuts")
    totals = dealt.groupBy(*by, "_part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*by, "_part", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("_p"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_n"))
    inside = Window.partitionBy(*by, "_part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt.withColumn("tp", F.sum("pos").over(inside))
        .withColumn("fp", F.sum("neg").over(inside))
        .join(shift, [*by, "_part"])
        .select(*by, "score", "pos", "neg", (F.col("tp") + F.col("_p")).alias("tp"), (F.col("fp") + F.col("_n")).alias("fp"))
    )


def average_precision(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum over distinct scores of the gain in recall times precision; null without positives."""
    return curve.groupBy(*(by or [])).agg((F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision"))


def roc_auc(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Chance that a positive scores above a negative, ties half; null with one class."""
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") * 0.5))
    return curve.groupBy(*(by or [])).agg((won / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"))


def f1_threshold(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The distinct score of greatest F1 as threshold, the highest on ties."""
    by = by or []
    totals = curve.groupBy(*by).agg(F.sum("pos").alias("_all"))
    joined = curve.join(F.broadcast(totals), by) if by else curve.crossJoin(F.broadcast(totals))  # one row for each group of by
    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("_all"))
    return joined.withColumn("f1", f1).groupBy(*by).agg(F.max_by("score", F.struct("f1", "score")).alias("threshold"), F.max("f1").alias("f1"))


def confusion(df: DataFrame, threshold: float, score: str = "score", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Counts and rates at a threshold: zero where precision, recall or F1 would divide by zero, null where a class is absent."""
    hit, pos = F.col(score) >= threshold, F.col(label) == 1
    n = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(label).cast("double")).alias("prevalence"),
        F.count_if(~hit & ~pos).alias("tn"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"), F.count_if(hit & pos).alias("tp"),
    )
    rate = lambda a, b: F.col(a) / F.nullif(b, F.lit(0))
    recall, tnr = rate("tp", F.col("tp") + F.col("fn")), rate("tn", F.col("tn") + F.col("fp"))
    return n.withColumns(
        {
            "precision": F.coalesce(rate("tp", F.col("tp") + F.col("fp")), F.lit(0.0)), "recall": F.coalesce(recall, F.lit(0.0)),
            "f1": F.coalesce(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), F.lit(0.0)),
            "balanced_accuracy": (recall + tnr) / 2, "fpr": 1 - tnr,
        }
    )


def log_loss(df: DataFrame, score: str = "score", label: str = "label", eps: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood of clipped probabilities."""
    p = F.greatest(F.least(F.col(score), F.lit(1 - eps)), F.lit(eps))
    return df.agg((-F.avg(F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p)))).alias("log_loss"))
