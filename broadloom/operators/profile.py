"""Column profiles from one (column, value, count) relation, drift and diagnostics roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.plans.arrays import column_moments, counted_values
from broadloom.session import write_read

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
PROFILE_FIELDS = ["row_count", "null_count", "non_finite", "distinct_count", "min_value", "max_value", "mean_value", "stddev_value", "observed_domain"]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value string, number double, n): how often each value of each column stands.

    Tasks count the values of record batches column by column and return each value
    once (or more often, for columns of very many values), whatever the number of
    columns; their counts are added by (column, value). Everything else in a profile
    derives from this relation. The two zeros are one value.
    """
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c] in NUMERIC]
    decimals = [c for c in columns if kinds[c].startswith("decimal")]
    parts = counted_values(df, numbers, [c for c in columns if kinds[c] not in NUMERIC])
    if decimals:
        parts = parts.withColumn("number", F.when(F.col("column_name").isin(decimals), F.col("value").try_cast("double")).otherwise(F.col("number")))
    return parts.groupBy("column_name", "value", "number").agg(F.sum("n").alias("n"))


def profile(counts: DataFrame) -> DataFrame:
    """One row per column: the PROFILE_FIELDS. Moments are over finite values, the deviation is the population's.

    Distinct values exclude null and include NaN and infinities. The relation is stored,
    as it is read for the means and again for the squares about them.
    """
    counts = write_read(counts)
    x, n = F.col("number"), F.col("n")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    fx = F.when(finite, x)
    weight = F.when(finite, n)
    total = F.sum(weight)
    mean = F.sum(fx * n) / total
    stats = counts.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), n)), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(x.isNotNull() & ~finite, n)), F.lit(0)).alias("non_finite"),
        F.count("value").alias("distinct_count"),
        F.min(fx).alias("min_value"),
        F.max(fx).alias("max_value"),
        mean.alias("mean_value"),
        total.alias("_total"),
        F.min(F.when(finite, x == F.floor(x))).alias("_whole"),
        F.min(F.when(finite, x.isin(0.0, 1.0))).alias("_binary"),
    )
    squares = counts.join(stats.select("column_name", "mean_value"), "column_name").groupBy("column_name").agg(F.sum(F.pow(fx - F.col("mean_value"), 2) * n).alias("_ss"))
    domain = (
        F.when(F.col("row_count") == F.col("null_count"), "unobserved").when(F.col("min_value").isNull(), "non_numeric").when(F.col("_binary"), "binary")
        .when(F.col("_whole") & (F.col("min_value") >= 0), "nonnegative_integer").when(F.col("_whole"), "integer").otherwise("real")
    )
    return stats.join(squares, "column_name").withColumn("stddev_value", F.sqrt(F.col("_ss") / F.col("_total"))).withColumn("observed_domain", domain).select("column_name", *PROFILE_FIELDS)


def top_values(counts: DataFrame, k: int = 12, hidden: tuple[str, ...] = ("hash", "source_file", "row_number")) -> DataFrame:
    """The ``k`` most frequent values of each column, ties by value text; identity columns are left out."""
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return counts.filter(~F.col("column_name").isin(*hidden) & F.col("value").isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("column_name", "rank", "value", "n")


def outliers(profiles: DataFrame, sigmas: float = 8.0) -> DataFrame:
    """Columns that are not binary and whose maximum lies beyond the mean by ``sigmas`` deviations."""
    return profiles.filter((F.col("stddev_value") > 0) & (F.col("observed_domain") != "binary") & (F.col("max_value") > F.col("mean_value") + sigmas * F.col("stddev_value")))


def drift(current: DataFrame, previous: DataFrame, fields: list[str]) -> DataFrame:
    """(column_name, field, before, after) where a field of a current column changed; vanished columns are not reported."""
    text = lambda df, name: df.select("column_name", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name)) for f in fields])).alias("x")).select("column_name", "x.*")
    both = text(current, "after").join(text(previous, "before"), ["column_name", "field"], "left")
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select("column_name", "field", "before", "after")


def rollup_issues(issues: DataFrame, k: int = 3) -> DataFrame:
    """One row per (severity, code, stage, feature): summed count and the first ``k`` examples; errors before warnings.

    Examples are cut to k by rank before they are collected.
    """
    keys = ["severity", "code", "stage", "feature"]
    w = Window.partitionBy(*keys).orderBy("source_file", "row_number", "value")
    examples = issues.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    some = examples.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "source_file", "row_number", "value"))), lambda x: F.concat_ws(":", x["source_file"], x["row_number"], x["value"])).alias("examples"))
    totals = issues.groupBy(*keys).agg(F.sum("count").alias("count"))
    null_safe = [totals[c].eqNullSafe(some[c]) for c in keys]
    cond = null_safe[0]
    for c in null_safe[1:]:
        cond &= c
    return totals.join(some, cond, "left").select(*[totals[c] for c in keys], "count", "examples").orderBy(F.when(F.col("severity") == "error", 0).otherwise(1), "code", "stage", "feature")


def bounded_examples(violations: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each (code, feature) by (source_file, row_number)."""
    w = Window.partitionBy("code", "feature").orderBy("source_file", "row_number")
    return violations.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def class_counts(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows of each class per split; both_classes tells whether both are there."""
    n = df.groupBy(split).agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
    return n.withColumn("both_classes", (F.col("negatives") > 0) & (F.col("positives") > 0))


def not_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, nulls) of the columns, in one pass."""
    return column_moments(df, columns).select("column_name", F.col("null_count").alias("nulls"))


def not_binary_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, violations): values of number columns that are neither null nor 0 or 1, in one pass."""
    return column_moments(df, columns).select("column_name", F.col("not_binary").alias("violations"))


def identity_issues(df: DataFrame, key: str = "hash", split: str = "split_name") -> DataFrame:
    """Later rows of a repeated identity: SPLIT_OVERLAP where the split differs from the first row's, else DUPLICATE.

    The first row is that of smallest (source_file, row_number). It is found by a
    reduction and joined back, so a key that holds many rows is no single group.
    """
    k = F.lower(F.col(key))
    rows = df.filter(F.col(key).isNotNull()).select(k.alias("identity"), "source_file", "row_number", F.col(split).alias("split"))
    # stored, so that the join has a shuffle of its own on both sides and a hot key can be split in it
    first = write_read(rows.groupBy("identity").agg(F.min(F.struct("source_file", "row_number", "split")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    later = rows.join(first, "identity").filter((F.col("source_file") != F.col("first.source_file")) | (F.col("row_number") != F.col("first.row_number")))
    code = F.when(F.col("split").eqNullSafe(F.col("first.split")), "DUPLICATE").otherwise("SPLIT_OVERLAP")
    return later.select(code.alias("code"), "identity", "source_file", "row_number", "split", F.col("first.split").alias("first_split"))


def row_fingerprint(df: DataFrame) -> F.Column:
    """SHA-256 of a row's sorted columns as JSON."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)


def table_digest(df: DataFrame) -> DataFrame:
    """One row that does not depend on row order: n_rows and the sum of row hashes."""
    h = F.conv(F.substring(row_fingerprint(df), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("string").alias("digest"))
