"""A corpus pipeline of five stages, each one operator of broadloom.llm, over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadloom.llm import exact_dedup, language_id, packing, secrets, simhash
from broadloom.llm.common import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected, null, empty and letterless texts among them.

    Ids play no part in the decision, so null ids and repeated rows stay or go by their
    text; an empty table stays empty; all columns are kept as they are.
    """
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the rows of equal texts: that of smallest doc_id, null ids after all others.

    Null text counts as empty; of rows repeated with id and text one stays; an empty
    table stays empty; all columns are kept as they are.
    """
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: that of smallest doc_id, null ids after all others.

    All texts without words are one component; of rows repeated with id and text one
    stays; an empty table stays empty; all columns are kept as they are.
    """
    return simhash.keep_one(docs)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows. No row goes.

    Null and empty texts, null ids and repeated rows pass as they are; an empty table
    stays empty; all other columns are kept as they are.
    """
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into training sequences; one row per piece, every row of ``docs`` in one piece or more.

    Null text counts as empty and is the end token alone; repeated rows are packed each
    for itself; an empty table gives no pieces; other columns are not read. Few words are
    remembered and nothing is held between tasks, as workers of the stages hold memory of
    their own.
    """
    return packing.pack_documents(docs, memory=100_000, keep=False)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_dedup", near), ("secret_redaction", secret), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written as Parquet and read as the next stage's input.

    Every stage works on all that the one before kept; see the stages for nulls, ties,
    repeated rows and empty tables. The result is that of packing.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Stages 1, 3 and 5 have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
