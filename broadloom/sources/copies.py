"""Sinks: full refresh, grouped and chunked copies, verification, and recovery of interrupted copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.session import write_read

KEYS = ["source_file", "row_number"]


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh of a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def grouped_write(tables: list[DataFrame], path: str, group: int = 4) -> int:
    """Writes tables in groups: the first group replaces, later ones append. Returns the number of groups."""
    groups = [tables[i : i + group] for i in range(0, len(tables), group)]
    for k, some in enumerate(groups):
        union = some[0]
        for other in some[1:]:
            union = union.unionByName(other)
        union.write.mode("append" if k else "overwrite").parquet(path)
    return len(groups)


def chunked_copy(df: DataFrame, path: str, chunk_rows: int = 25_000, row_limit: int | None = None) -> None:
    """Copies a table in files of at most ``chunk_rows`` rows; an empty table still leaves its schema."""
    df = df if row_limit is None else df.limit(row_limit)
    df.write.mode("overwrite").option("maxRecordsPerFile", chunk_rows).parquet(path)


def select_tables(names: list[str], prefix: str, required: list[str]) -> list[str]:
    """Names that start with ``prefix``; a required name that is absent is an error."""
    if missing := sorted(set(required) - set(names)):
        raise ValueError(f"missing tables: {missing}")
    return sorted(n for n in names if n.startswith(prefix))


def copy_report(source: DataFrame, copy: DataFrame, name: str) -> DataFrame:
    """One row: table_name, source_rows, copied_rows, verified."""
    n = lambda df, alias: df.agg(F.count(F.lit(1)).alias(alias))
    return n(source, "source_rows").crossJoin(n(copy, "copied_rows")).select(F.lit(name).alias("table_name"), "source_rows", "copied_rows", (F.col("source_rows") == F.col("copied_rows")).alias("verified"))


def key_inventory(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Problems of the key: rows (keys, n, problem) for null keys and repeated ones; none if it is sound."""
    null = F.lit(False)
    for k in keys:
        null |= F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("problem", F.when(null, "null").when(F.col("n") > 1, "duplicate")).filter("problem IS NOT NULL")


def foreign_keys(copy: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys of the copy that the source lacks."""
    return copy.select(*keys).join(source.select(*keys), keys, "left_anti")


def missing_keys(copy: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys of the source that the copy lacks."""
    return foreign_keys(source, copy, keys)


def missing_ranges(missing: DataFrame, buckets: int = 1 << 20) -> DataFrame:
    """Contiguous ranges of missing row numbers: source_file, first_row, last_row, n_rows.

    Runs are found inside stretches of ``buckets`` row numbers, so that one large
    file is many groups, and runs that touch over a border are joined after.
    """
    stretch = F.floor(F.col("row_number") / buckets)
    inside = Window.partitionBy("source_file", "stretch").orderBy("row_number")
    runs = (
        missing.select(*KEYS, stretch.alias("stretch"))
        .withColumn("island", F.col("row_number") - F.row_number().over(inside))
        .groupBy("source_file", "stretch", "island")
        .agg(F.min("row_number").alias("a"), F.max("row_number").alias("b"))
    )
    file = Window.partitionBy("source_file").orderBy("a")
    starts = F.when(F.col("a") == F.lag("b").over(file) + 1, 0).otherwise(1)
    return runs.withColumn("new", starts).withColumn("k", F.sum("new").over(file)).groupBy("source_file", "k").agg(F.min("a").alias("first_row"), F.max("b").alias("last_row")).select("source_file", "first_row", "last_row", (F.col("last_row") - F.col("first_row") + 1).alias("n_rows"))


def in_ranges(df: DataFrame, ranges: DataFrame, width: int = 1024) -> DataFrame:
    """Rows whose (source_file, row_number) lies in a range, by an equi-join on stretches of ``width`` rows."""
    cell = lambda c: F.floor(F.col(c) / width)
    pieces = ranges.select("source_file", "first_row", "last_row", F.explode(F.sequence(cell("first_row"), cell("last_row"))).alias("_cell"))
    rows = df.withColumn("_cell", cell("row_number"))
    hit = (rows["source_file"] == pieces["source_file"]) & (rows["_cell"] == pieces["_cell"]) & rows["row_number"].between(pieces["first_row"], pieces["last_row"])
    return rows.join(pieces, hit, "left_semi").drop("_cell")


def key_counts(copy: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """(keys, in_copy, in_source): how often each key stands in either table; one grouping of both, null equals null."""
    tagged = lambda df, mine: df.select(*keys, F.lit(int(mine)).alias("c"), F.lit(int(not mine)).alias("s"))
    return tagged(copy, True).unionByName(tagged(source, False)).groupBy(*keys).agg(F.sum("c").alias("in_copy"), F.sum("s").alias("in_source"))


def key_differences(copy: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The rows of ``key_counts`` that differ: foreign keys (in_source 0), missing ones (in_copy 0), unequal counts."""
    return key_counts(copy, source, keys).filter("in_copy <> in_source")


def keys_equal(a: DataFrame, b: DataFrame, keys: list[str] = KEYS) -> bool:
    """Whether both tables hold the same keys equally often."""
    return key_differences(a, b, keys).isEmpty()


def recover(spark: SparkSession, source: DataFrame, path: str, fingerprint: str, expected: str, keys: list[str] = KEYS) -> dict[str, int]:
    """Appends to the copy at ``path`` the rows it lacks, and checks that the keys are equal after.

    Refuses another source than the expected one, null or repeated keys, and keys of
    the copy that the source lacks; all that is read off one grouping of both tables'
    keys, which is stored. A second run appends nothing.
    """
    if fingerprint != expected:
        raise ValueError("the source is not the expected snapshot")
    copy = spark.read.parquet(path)
    state = write_read(key_counts(copy, source, keys))
    null = F.lit(False)
    for k in keys:
        null |= F.col(k).isNull()
    found = state.agg(
        F.count_if((null & (F.col("in_source") > 0)) | (F.col("in_source") > 1)).alias("source"), F.count_if((null & (F.col("in_copy") > 0)) | (F.col("in_copy") > 1)).alias("copy"),
        F.count_if(F.col("in_source") == 0).alias("foreign"), F.count_if(F.col("in_copy") == 0).alias("missing"), F.coalesce(F.sum("in_copy"), F.lit(0)).alias("before"),
    ).first()
    for name in ("source", "copy"):
        if found[name]:
            raise ValueError(f"null or repeated keys in the {name}")
    if found["foreign"]:
        raise ValueError("the copy holds keys that the source lacks")
    if found["missing"]:
        source.join(state.filter("in_copy = 0").select(*keys), keys, "left_semi").select(*copy.columns).write.mode("append").parquet(path)
        if not keys_equal(spark.read.schema(copy.schema).parquet(path), source, keys):
            raise ValueError("the copy does not equal the source after recovery")
    return {"before": found["before"], "appended": found["missing"], "after": found["before"] + found["missing"]}


def load_dictionary(spark: SparkSession, mapping_csv: str, payload_json: str, stamp: dict[str, str], payload_schema: str | None = None, mapping_schema: str | None = None) -> dict[str, DataFrame]:
    """Three tables, each row stamped: features (token mapping with descriptions), categories, columns.

    The payload holds arrays ``features``, ``categories`` and ``columns`` of objects.
    Schemas that are not given are found by a pass over all files, of JSON in tasks of
    as many files as 128 MB hold. Given ones must name the fields as the files do; a
    payload that does not parse is an error then, and so is a mapping whose header
    says something else.
    """
    json = spark.read.option("multiLine", "true")
    payload = (json.schema(payload_schema).option("mode", "FAILFAST") if payload_schema else json).json(payload_json)
    stamps = {n: F.lit(v) for n, v in stamp.items()}
    tables = {name: payload.select(F.explode(name).alias("x")).select("x.*").withColumns(stamps) for name in ("features", "categories", "columns")}
    csv = spark.read.option("header", "true").option("enforceSchema", mapping_schema is None)
    mapping = (csv.schema(mapping_schema).option("mode", "FAILFAST") if mapping_schema else csv).csv(mapping_csv)
    return tables | {"features": mapping.join(tables["features"], "token", "left")}


def write_once(df: DataFrame, path: str) -> None:
    """Writes a result that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)
