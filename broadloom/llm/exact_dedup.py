"""Exact dedup by content-defined chunk recipes.

One pass over the texts cuts every normalised text into content-defined chunks
and keeps only their digests. Distinct chunks become verified identifiers, a
document becomes its ordered list of identifiers (its recipe), and documents are
compared by recipe: no text moves after the first pass, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import keep_rows, sized_join, stored

SPACE = re.compile(rb"[\x20\x09-\x0D]+")
#: Bytes that the rolling hash sees; a cut follows where its low bits are zero.
WINDOW = 32
CHUNK_BITS = 11
CHUNK_MIN, CHUNK_MAX = 256, 16384

_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
_CHUNKS = "row_id long, doc_id long, text_sha256 string, chunks array<struct<print:long,sha:binary,bytes:int>>"


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text with every run of ASCII white space as one space; null is empty."""
    return SPACE.sub(b" ", (text or "").encode("utf-8", "surrogatepass"))


def chunk_bounds(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of ``data``; an empty text has none.

    The hash of the last 32 bytes is a sum of shifted table entries, built by
    doubling, so that equal surroundings give equal cuts wherever they stand.
    """
    n = len(data)
    if n <= CHUNK_MIN:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < WINDOW:  # h[i] covers bytes i-width+1..i
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    ends, last = [], 0
    for cut in (np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1).tolist():
        while cut - last > CHUNK_MAX:
            last += CHUNK_MAX
            ends.append(last)
        if cut - last >= CHUNK_MIN and cut < n:
            ends.append(cut)
            last = cut
    while n - last > CHUNK_MAX:
        last += CHUNK_MAX
        ends.append(last)
    return [*ends, n]


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"row_id": batch.column("row_id").to_pylist(), "doc_id": batch.column("doc_id").to_pylist(), "text_sha256": [], "chunks": []}
        for text in batch.column("text"):
            data = normalise(text.as_py())
            out["text_sha256"].append(hashlib.sha256(data).hexdigest())
            start, chunks = 0, []
            for end in chunk_bounds(data):
                piece = data[start:end]
                chunks.append({"print": xxhash.xxh64_intdigest(piece) - (1 << 63), "sha": hashlib.sha256(piece).digest(), "bytes": len(piece)})
                start = end
            out["chunks"].append(chunks)
        yield pa.RecordBatch.from_pydict(out, schema=_ARROW)


_ARROW = pa.schema(
    {"row_id": pa.int64(), "doc_id": pa.int64(), "text_sha256": pa.string(), "chunks": pa.list_(pa.struct({"print": pa.int64(), "sha": pa.binary(), "bytes": pa.int32()}))}
)


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, chunks): (row_id, doc_id, text_sha256, recipe array<long>) and (chunk_id, print, sha, bytes).

    A chunk's fingerprint is its XXH64; the identifier belongs to the verified
    triple of fingerprint, SHA-256 and length, so that chunks of equal
    fingerprint and different content get different identifiers. A null or
    empty text has an empty recipe. Repeated rows each keep a row_id.
    """
    scan = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    read = stored(scan.mapInArrow(_chunked, _CHUNKS))
    each = read.select("row_id", F.posexplode("chunks").alias("place", "chunk")).select("row_id", "place", "chunk.*")
    chunks = stored(each.select("print", "sha", "bytes").distinct().withColumn("chunk_id", F.monotonically_increasing_id()))
    lists = (
        each.join(chunks, ["print", "sha", "bytes"])
        .groupBy("row_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "chunk_id"))), lambda x: x["chunk_id"]).alias("recipe"))
    )
    documents = read.select("row_id", "doc_id", "text_sha256").join(lists, "row_id", "left").withColumn("recipe", F.coalesce("recipe", F.array().cast("array<long>")))
    return documents, chunks


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their recipes are; the whole-text SHA-256 is part of the
    key, an independent check of every group. The row of smallest doc_id stays; of
    rows that repeat it, the first read. Null ids come after all others (a group of
    only null ids keeps its first row, keep_id null). Null text counts as empty.
    An empty table gives an empty result; other columns are not read.
    """
    documents, _ = chunk_recipes(docs, id_col, text_col)
    rows = stored(documents.select("row_id", "doc_id", "text_sha256", F.xxhash64("recipe").alias("recipe_hash"), "recipe"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    keys = ["recipe_hash", "recipe", "text_sha256"]
    groups = rows.groupBy(*keys).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # only groups of two or more are joined back; stored, so that a large group can be split in the join
    found = sized_join(rows, stored(groups), keys, "left")
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_id") == F.col("first.row_id"))).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with their own columns and texts.

    Of each group one row stays: that of smallest doc_id, null ids after all others; of
    rows that share the id, one of them. Null text counts as empty. An empty table
    stays empty; other columns, of whatever names, are kept as they are.
    """

    def mark(doc_id: F.Column, sha: F.Column) -> F.Column:
        return F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), sha), 256))

    decided = exact_dedup(docs).select(mark(F.col("doc_id"), F.col("text_sha256")).alias("key"), "kept")
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    return keep_rows(docs, decided, mark(F.col("doc_id").cast("long"), sha))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of the whole documents table."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = {
    "op9_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, sha256(body) AS text_sha256, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
}
