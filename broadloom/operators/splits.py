"""Splits, feature sets, ablations and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.functions.scalars import hash_bucket

MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"


def split_hash(split: Column, key: Column, seed: str, validation: int = 2000) -> Column:
    """Published test stays test; published train is validation for hash buckets under ``validation``, else train; other names null."""
    return F.when(split == "test", "test").when(split == "train", F.when(hash_bucket(key, seed) < validation, "validation").otherwise("train"))


def split_temporal(split: Column, month: Column, train_through: str, validation_through: str) -> Column:
    """By month: up to ``train_through`` train, up to ``validation_through`` validation, later test; null for invalid months or published splits."""
    if not train_through < validation_through:
        raise ValueError("the cutoffs must be ordered")
    valid = split.isin("train", "test") & month.rlike(MONTH)
    return F.when(valid, F.when(month <= train_through, "train").when(month <= validation_through, "validation").otherwise("test"))


def with_policy(df: DataFrame, policy: str, **inputs: str) -> DataFrame:
    """``df`` stamped with the split policy and its inputs."""
    return df.withColumn("split_policy", F.lit(policy)).withColumn("split_inputs", F.lit(",".join(f"{k}={v}" for k, v in sorted(inputs.items()))))


def vector(columns: list[str]) -> Column:
    """The ordered features as one array of floats; ``pyspark.ml.functions.array_to_vector`` makes it a vector."""
    return F.array(*[F.col(c).cast("float") for c in columns])


def layout(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The ordered columns by storage type."""
    kinds = dict(df.dtypes)
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(kinds[c], []).append(c)
    return groups


def ablations(base: list[str], variants: dict[str, dict]) -> dict[str, list[str]]:
    """Column lists of named variants: each has include, exclude (lists) or replace (a mapping)."""
    out = {}
    for name, change in variants.items():
        columns = [c for c in base if c not in change.get("exclude", [])]
        if unknown := set(change.get("exclude", [])) - set(base) or set(change.get("replace", {})) - set(base):
            raise ValueError(f"{name}: not in the base set: {sorted(unknown)}")
        out[name] = [change.get("replace", {}).get(c, c) for c in columns] + [c for c in change.get("include", []) if c not in columns]
    return out


def ablation_rows(df: DataFrame, key: str, variants: dict[str, list[str]]) -> DataFrame:
    """Long form of all variants in one pass: (variant, key, feature, value)."""
    cells = [F.struct(F.lit(v).alias("variant"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for v, columns in variants.items() for c in columns]
    return df.select(key, F.explode(F.array(*cells)).alias("x")).select("x.variant", key, "x.feature", "x.value")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, weight): all rows over twice the rows of the class."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select(label, (F.col("total") / (2 * F.col("n"))).alias("weight"))  # one row
