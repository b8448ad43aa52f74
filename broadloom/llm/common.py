"""Helpers that the operators share: shared storage, sized joins, Arrow grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from broadloom.session import free_names, scratch

#: Rows and bytes up to which a right side is broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the folder that the cluster names in spark.checkpoint.dir; see ``scratch``."""
    return scratch(spark)


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> F.Column:
    """32 bytes that rows of ``df`` share if and only if id and text are equal, but for SHA-256 collisions; null equals null."""
    none = lambda c: F.when(F.col(c).isNull(), "-").otherwise("+")
    return F.unhex(F.sha2(F.concat(none(id_col), none(text_col), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))), 256))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    Cuts the lineage: what follows survives lost executors without a rerun of
    the work before it, and Spark knows the table's size when it plans a join.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Deletes the files of a stored table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _width(c: F.Column, kind) -> F.Column:
    """Bytes of a value in memory, about."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, ArrayType):
        return F.lit(24) + F.aggregate(F.coalesce(c, F.array().cast(kind)), F.lit(0).cast("long"), lambda n, x: n + _width(x, kind.elementType))
    if isinstance(kind, StructType):
        out = F.lit(16).cast("long")
        for field in kind.fields:
            out = out + _width(c[field.name], field.dataType)
        return out
    return F.lit(8).cast("long")


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A join that broadcasts ``right`` (a stored table) only if its rows, counted, and their bytes, summed, are few.

    Beyond ``rows`` or ``size`` Spark joins by shuffle, where adaptive execution splits skewed keys.
    """
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in right.schema.fields), F.lit(0).cast("long"))
    n, held = right.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return left.join(F.broadcast(right) if n <= rows and held <= size else right, on, how)


def keep_rows(docs: DataFrame, decided: DataFrame, key: F.Column, once: bool = True) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is kept in ``decided`` (key, kept), with their own columns.

    ``decided`` has a row for each row of ``docs``; rows of a key are decided alike,
    or, with ``once``, one of them is kept and comes out once. Keys are 32 bytes; what
    goes is joined by a sized broadcast or a shuffle.
    """
    (name,) = free_names(docs, "row_key")
    found = decided.groupBy("key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    # only keys that go or that stand on several rows are joined back
    found = stored(found.filter(~F.col("kept") | (F.col("n") > 1)).select(F.col("key").alias(name), "kept"))
    keyed = docs.withColumn(name, key)
    if not once:
        return sized_join(keyed, found.filter(~F.col("kept")).select(name), [name], "left_anti").select(*docs.columns)
    rest = sized_join(keyed, found.select(name), [name], "left_anti")
    again = sized_join(keyed, found.filter("kept").select(name), [name], "left_semi").dropDuplicates([name])
    return rest.unionByName(again).select(*docs.columns)


def arrow_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Yields tables of whole groups, with the bounds of the groups (end included), from rows sorted by ``keys``.

    Keys are non-null integer columns. Holds one batch and the open last group.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for key in keys:
            change |= np.diff(table.column(key).to_numpy()) != 0
        starts = np.flatnonzero(change) + 1
        if not len(starts):
            rest = table
            continue
        cut = int(starts[-1])
        rest = table.slice(cut)
        yield table.slice(0, cut), np.append(0, starts)
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])
