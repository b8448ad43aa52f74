"""Tables of snapshots: appended files under field ids, and an append-only list of what each snapshot holds.

A commit writes its rows to a folder of its own, their columns named by field id, and
the lengths and times of these files beside it; it counts once its marker is there,
which only one writer can create. A snapshot is resolved by its number: its schema
names the ids, so columns can be renamed or added without a rewrite.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from broadloom.session import sized_files


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, its path) of an address."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that must not exist yet; False if another writer was first. Readers see no file or all of it."""
    fs, target = file_system(spark, path)
    _, draft = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    if fs.exists(target):
        return False
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    # a rename onto a file that exists is refused
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


@dataclass(frozen=True)
class Snapshot:
    """One snapshot: its number, (field id, name, type as JSON) of each column, and the folders of its commits."""

    number: int
    fields: tuple[tuple[int, str, str], ...]
    folders: tuple[str, ...]

    @property
    def fingerprint(self) -> str:
        import hashlib

        return hashlib.sha256(json.dumps([self.number, self.fields, self.folders]).encode()).hexdigest()


class SnapshotTable:
    """A table at ``path``; every commit makes the next snapshot."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def snapshot(self, number: int | None = None) -> Snapshot | None:
        """A snapshot by number, the newest if none is given (None for a table without one); an absent one is refused."""
        if number is None:
            number = 0
            while read_small(self.spark, f"{self.path}/snapshots/{number + 1}.json") is not None:
                number += 1
            if not number:
                return None
        text = read_small(self.spark, f"{self.path}/snapshots/{number}.json")
        if text is None:
            raise ValueError(f"no snapshot {number}")
        x = json.loads(text)
        return Snapshot(number, tuple(map(tuple, x["fields"])), tuple(x["folders"]))

    def commit(self, rows: DataFrame | None, renamed: dict[str, str] | None = None) -> Snapshot:
        """Appends rows, after renaming columns of the newest snapshot; columns that it lacks get new ids.

        A commit that another writer was faster than is an error and leaves nothing that readers see.
        """
        last = self.snapshot()
        renamed = renamed or {}
        fields = [(i, renamed.get(name, name), kind) for i, name, kind in (last.fields if last else ())]
        if unknown := set(renamed) - {name for _, name, _ in (last.fields if last else ())}:
            raise ValueError(f"no columns to rename: {sorted(unknown)}")
        folders = list(last.folders) if last else []
        if rows is not None:
            known = {name: (i, kind) for i, name, kind in fields}
            for f in rows.schema.fields:
                kind = json.dumps(f.dataType.jsonValue())
                if f.name not in known:
                    known[f.name] = (1 + max((i for i, _ in known.values()), default=0), kind)
                    fields.append((known[f.name][0], f.name, kind))
                elif known[f.name][1] != kind:
                    raise ValueError(f"{f.name} has another type in the table")
            folder = f"{self.path}/data/{uuid.uuid4().hex}"
            rows.select(*[F.col(f"`{c}`").alias(f"id_{known[c][0]}") for c in rows.columns]).write.parquet(folder)
            sized_files(self.spark, [folder]).coalesce(1).write.parquet(f"{self.path}/files/{folder.rsplit('/', 1)[1]}")
            folders.append(folder)
        number = (last.number if last else 0) + 1
        if not create_once(self.spark, f"{self.path}/snapshots/{number}.json", json.dumps({"fields": fields, "folders": folders})):
            raise ValueError(f"another writer made snapshot {number}")
        return Snapshot(number, tuple(fields), tuple(folders))

    def changed_files(self, snapshot: Snapshot) -> DataFrame:
        """(path, what) of files that are gone, new or of another length or time than when they were committed."""
        held = self.spark.read.schema("path string, length long, modified timestamp").parquet(*[f"{self.path}/files/{f.rsplit('/', 1)[1]}" for f in snapshot.folders])
        now = sized_files(self.spark, list(snapshot.folders)).select("path", F.col("length").alias("length_now"), F.col("modified").alias("modified_now"))
        both = held.join(now, "path", "full")
        what = F.when(F.col("length_now").isNull(), "gone").when(F.col("length").isNull(), "new").when((F.col("length") != F.col("length_now")) | (F.col("modified") != F.col("modified_now")), "rewritten")
        return both.select("path", what.alias("what")).filter("what IS NOT NULL")

    def read(self, number: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """The rows of a snapshot under its names; columns that a commit did not have are null. A table whose files were rewritten is refused."""
        snapshot = self.snapshot(number)
        if snapshot is None:
            raise ValueError("the table has no snapshot")
        wanted = [f for f in snapshot.fields if columns is None or f[1] in columns]
        if columns is not None and (missing := set(columns) - {f[1] for f in wanted}):
            raise ValueError(f"no columns {sorted(missing)} in snapshot {snapshot.number}")
        if not snapshot.folders:
            raise ValueError("the snapshot has no rows")
        if (changed := self.changed_files(snapshot).first()) is not None:
            raise ValueError(f"not the snapshot's files any more: {changed.path} is {changed.what}")
        physical = StructType([StructField.fromJson({"name": f"id_{i}", "type": json.loads(kind), "nullable": True, "metadata": {}}) for i, _, kind in snapshot.fields])
        df = self.spark.read.schema(physical).parquet(*snapshot.folders)
        names = {name: i for i, name, _ in wanted}
        return df.select(*[F.col(f"id_{names[c]}").alias(c) for c in (columns or [f[1] for f in wanted])])
