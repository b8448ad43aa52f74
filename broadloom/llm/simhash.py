"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint has eight byte positions. Two fingerprints that differ in at most
four bits share at least four positional bytes (the guaranteed minimum). The
index's posting lists are keyed by three positions and their bytes; the triples
form a covering design, so that any four shared positions contain a listed
triple. In a list the shared positional bytes of each pair are tallied, pairs
that reach the minimum are kept and their differing bits counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import keep_rows, row_key, sized_join, stored
from broadloom.llm.components import compare_blocks, connected_components, forest

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
POSITIONS = 8
MAX_BITS = 4
BLOCK_ROWS = 2048


def covering_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the eight positions such that every four positions contain one.

    Turan's construction: positions in three classes of sizes 3, 3, 2; a triple is
    listed if it lies in one class, or has two positions in one class and the
    third in the next class around.
    """
    kind = [0, 0, 0, 1, 1, 1, 2, 2]
    listed = []
    for t in combinations(range(POSITIONS), 3):
        counts = [sum(kind[p] == c for p in t) for c in range(3)]
        if 3 in counts or any(counts[c] == 2 and counts[(c + 1) % 3] == 1 for c in range(3)):
            listed.append(t)
    return listed


def fingerprint(text: str | None, words: int = 4) -> int:
    """SimHash of the text's word shingles; see ``fingerprints``."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(bytes.maketrans(UPPER, LOWER))
    parts = WORD.findall(data)
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)]
    n = len(hashes)
    bits = np.zeros(64, np.int64)
    h = np.array(hashes, dtype=np.uint64)
    for i in range(0, n, 65536):
        bits += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, key: F.Column | None = None) -> DataFrame:
    """(doc_id, key, fp long) for every row; ``key`` is binary, null where none is asked for.

    A-Z is lowered, words are runs without ASCII white space, shingles have
    ``words`` words (fewer words: the whole sequence). No words, so also a null or
    empty text: fingerprint 0. Texts are hashed shingle by shingle, never cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    key = F.lit(None).cast("binary") if key is None else key
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, key binary, fp long")


def _compare(prepared: dict, rows: slice, second: np.ndarray | None) -> dict[str, np.ndarray] | None:
    fps = prepared["fp"][rows]
    a, b = (fps, fps) if second is None else (fps[~second], fps[second])
    step = max(1, (1 << 18) // len(b))
    near = np.zeros((len(a), len(b)), dtype=bool)
    for i in range(0, len(a), step):
        x = (a[i : i + step, None] ^ b[None, :]).view(np.uint64)
        shared = (np.ascontiguousarray(x)[..., None].view(np.uint8) == 0).sum(axis=-1)
        at, cols = np.nonzero(shared >= POSITIONS - MAX_BITS)
        good = np.bitwise_count(x[at, cols]) <= MAX_BITS
        near[i + at[good], cols[good]] = True
    if second is None:
        np.fill_diagonal(near, False)
    if not near.any():
        return None
    if second is None:
        ids, whole = a, near
    else:
        ids, whole = np.concatenate([a, b]), np.zeros((len(fps), len(fps)), dtype=bool)
        whole[: len(a), len(a) :] = near
        whole[len(a) :, : len(a)] = near.T
    src, dst = forest(ids, whole)
    return {"src": src, "dst": dst}


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(src, dst): a spanning forest of the links between the distinct values of ``fp``."""
    keys = []
    for k, triple in enumerate(covering_triples()):
        key = F.lit(k).cast("long")
        for p in triple:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftright(F.col("fp"), 8 * p).bitwiseAND(F.lit(255).cast("long")))
        keys.append(key)
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("list_key"))
    return compare_blocks(postings, ["list_key"], "fp", [], lambda t: {"fp": t.column("fp").to_numpy()}, _compare, "src long, dst long", BLOCK_ROWS)


def _components(rows: DataFrame, first: F.Column) -> DataFrame:
    """Stored (fp, least): the smallest ``first`` over the rows (stored) of each fingerprint's component."""
    classes = stored(rows.groupBy("fp").agg(F.min(first).alias("least")))
    parts = connected_components(fingerprint_links(classes.select("fp")))
    member = classes.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    least = stored(member.groupBy("part").agg(F.min("least").alias("least")))
    return stored(member.select("fp", "part").join(least, "part").select("fp", "least"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    Rows of one fingerprint are one class before any comparison, so a group of any
    number of copies costs one index entry. component_id is the smallest doc_id
    reachable over links of at most four bits (null ids take no part in the
    minimum; a component of only null ids has null). ``kept``: doc_id = component_id.
    Empty tables give empty results; other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words).select("doc_id", "fp"))
    of = _components(rows, F.col("doc_id")).withColumnRenamed("least", "component_id")
    return sized_join(rows, of, ["fp"], "inner").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which SimHash keeps one for each component, with their own columns.

    The row of smallest doc_id stays (null ids come after all others; of rows of one id
    the text's digest decides), and one of rows repeated with id and text. All texts
    without words (null, empty) are one component. An empty table stays empty; other
    columns, of whatever names, are kept as they are.
    """
    key = row_key(docs)
    rows = stored(fingerprints(docs, key=key))
    least = _components(rows, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    decided = sized_join(rows, least, ["fp"], "inner").select("key", (F.col("key") == F.col("least.key")).alias("kept"))
    return keep_rows(docs, decided, key)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-dedup of the whole documents table."""
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
