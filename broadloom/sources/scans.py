"""Scans: file manifests, provenance, pinned and delete-aware reads, text logs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from broadloom.session import sized_files

PROVENANCE = ["dataset_id", "config_name", "split_name", "row_number", "source_file"]


def file_manifest(spark: SparkSession, folder: str, configs: list[str] | None = None) -> DataFrame:
    """Parquet shards under ``folder``: path, file_name, config_name (the parent folder), split_name, bytes, n_files.

    A shard is a file, or a folder named ``*.parquet`` whose part files count together.
    split_name comes from a ``_train`` or ``_test`` ending, else null. With ``configs``
    only shards of those folders that name a split stay. Sorted by config and path;
    contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder).select("path", "length")
    # the folder's own name may end in .parquet too; only what stands below it names shards
    top = F.lit(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", folder).rstrip("/") + "/")
    place = F.instr("path", top)
    at = F.when(place > 0, place + F.length(top) - 1).otherwise(0)
    shard = F.concat(F.substring("path", F.lit(1), at), F.regexp_extract(F.substring("path", at + 1, F.length("path")), r"^.*?\.parquet(?=/|$)", 0))
    shards = files.groupBy(shard.alias("path")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n_files"))
    split = F.regexp_extract("path", r"_(train|test)\.parquet$", 1)
    out = shards.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.element_at(F.split("path", "/"), -2).alias("config_name"),
        F.when(split != "", split).alias("split_name"),
        "bytes",
        "n_files",
    )
    if configs is not None:
        out = out.filter(F.col("config_name").isin(configs) & F.col("split_name").isNotNull())
    return out.orderBy("config_name", "path")


def with_provenance(scan: DataFrame, dataset_id: str, config_name: str, split_name: str) -> DataFrame:
    """A Parquet scan with the provenance columns in front; columns of the same names are replaced.

    row_number is the physical position of the row in its file, source_file the file's name.
    """
    rest = [c for c in scan.columns if c not in PROVENANCE]
    return scan.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(config_name).alias("config_name"),
        F.lit(split_name).alias("split_name"),
        F.col("_metadata.row_index").alias("row_number"),
        F.col("_metadata.file_name").alias("source_file"),
        *rest,
    )


def limit_per_file(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` physical rows of each file of a provenance table; a filter, without shuffle."""
    return rows.filter(F.col("row_number") < n)


def first_files(rows: DataFrame, m: int) -> DataFrame:
    """Rows of the first ``m`` files by name. The distinct names are ranked, not the rows."""
    names = rows.select("source_file").distinct().orderBy("source_file").limit(m)
    return rows.join(F.broadcast(names), "source_file", "left_semi")  # at most m rows


def first_rows_per_split(rows: DataFrame, n: int, order: list[str], splits: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows of each (config_name, split_name), optionally of some splits only.

    The rank filter runs before the shuffle too, so at most n rows of a group leave a task.
    """
    if splits is not None:
        rows = rows.filter(F.col("split_name").isin(splits))
    w = Window.partitionBy("config_name", "split_name").orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def _fingerprint(spark: SparkSession, files: tuple[str, ...], schema: StructType) -> str:
    """SHA-256 of the files' names, lengths and times, from the listing, and the schema."""
    import hashlib

    listed = sorted((r.path, r.length, str(r.modified)) for r in sized_files(spark, list(files)).collect())
    return hashlib.sha256("\n".join([*map(str, listed), schema.json()]).encode()).hexdigest()


@dataclass(frozen=True)
class PinnedTable:
    """A table as of one moment: its files, schema and fingerprint. Later files are not seen."""

    files: tuple[str, ...]
    schema: StructType
    fingerprint: str

    @classmethod
    def of(cls, table: DataFrame) -> PinnedTable:
        """Pins the files of a Parquet table; a table without files is an error."""
        files = tuple(sorted(table.inputFiles()))
        if not files:
            raise ValueError("no snapshot: the table has no files")
        return cls(files, table.schema, _fingerprint(table.sparkSession, files, table.schema))

    def read(self, spark: SparkSession, columns: list[str] | None = None, dataset_id: str | None = None, config_name: str | None = None) -> DataFrame:
        """The pinned rows of one dataset and config; an identity column that the table lacks filters nothing.

        Filters and the column list reach the Parquet scan. A missing column is an error,
        and so is a file that was rewritten under its name since.
        """
        if _fingerprint(spark, self.files, self.schema) != self.fingerprint:
            raise ValueError("the pinned files are not what they were")
        df = spark.read.schema(self.schema).parquet(*self.files)
        for name, value in (("dataset_id", dataset_id), ("config_name", config_name)):
            if value is not None and name in df.columns:
                df = df.filter(F.col(name) == value)
        return df if columns is None else df.select(*columns)


def without_deleted(scan: DataFrame, deletes: DataFrame) -> DataFrame:
    """Drops rows at deleted (source_file, row_number) positions of a provenance table.

    To be called before any filter: positions count physical rows.
    """
    return scan.join(deletes.select("source_file", "row_number"), ["source_file", "row_number"], "left_anti")


def evolve(df: DataFrame, renamed: dict[str, str], added: dict[str, object]) -> DataFrame:
    """An old file's columns under the names of the current schema; missing fields take given values."""
    for old, new in renamed.items():
        df = df.withColumnRenamed(old, new)
    return df.withColumns({n: F.lit(v) for n, v in added.items() if n not in df.columns})


def drop_loader_columns(df: DataFrame, prefix: str = "_dlt_") -> DataFrame:
    """``df`` without the loader's own columns."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def read_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(source_file, line_number, raw_line) of text files: 1-based line numbers, line ends stripped.

    Lines are numbered inside each split of a file and shifted by the lines of the
    splits before it, so a large file is read by many tasks.
    """
    m = F.col("_metadata")
    lines = spark.read.text(path).select(m["file_path"].alias("source_file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\r$", "").alias("raw_line"))
    inner = F.row_number().over(Window.partitionBy("source_file", "block").orderBy("at"))
    counts = lines.groupBy("source_file", "block").count()
    before = F.sum("count").over(Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select("source_file", "block", F.coalesce(before, F.lit(0)).alias("shift"))
    out = lines.withColumn("inner", inner).join(shift, ["source_file", "block"]).select("source_file", (F.col("shift") + F.col("inner")).alias("line_number"), "raw_line")
    return out if limit is None else out.filter(F.col("line_number") <= limit)


def require_rows(df: DataFrame) -> DataFrame:
    """``df``, or an error if it has no row."""
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df
