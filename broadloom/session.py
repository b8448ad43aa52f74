"""Session settings and shared storage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "broadloom", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution, the settings that results rely on."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    return SparkSession.builder.appName(name).config(map=base | conf).getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir.

    Where that setting is absent a local folder is set, if driver and executors are one
    process; on a cluster, whose machines do not share such a folder, that is an error.
    """
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not top:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_read(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new shared folder and read again."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, length, modified) of the Parquet files in some folders, from the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folders)
    return files.selectExpr("path", "length", "modificationTime AS modified")
