"""Embedding near-dedup by spherical-cap filters with structured random product codes.

Directions of filters are all combinations of one code vector per block of
coordinates (a product code, after a random rotation). A vector belongs to every
filter whose direction it exceeds by ``cap``; these are list-decoded block by
block, without looking at the other directions. Vectors that share a filter are
compared exactly. A link is counted in the smallest filter that both share, so
counts need no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import sized_join, stored
from broadloom.llm.components import compare_blocks, connected_components, forest

THRESHOLD = 0.93
#: Independent rotations, blocks of the product code, code vectors in each (so CODES ** BLOCKS
#: filters for a rotation), and the share of directions that lie in a filter's cap.
ROTATIONS, BLOCKS, CODES, CAP_SHARE = 6, 2, 256, 2.5e-5
SEED = 20160331
BLOCK_ROWS = 1024


def cap_cosine(dim: int, share: float = CAP_SHARE) -> float:
    """The cosine that a share of all directions exceeds, in ``dim`` dimensions."""
    angle = np.linspace(0, np.pi, 200_001)
    area = np.cumsum(np.sin(angle) ** max(dim - 2, 0))
    return float(np.cos(angle[np.searchsorted(area, share * area[-1])]))


class ProductCode:
    """One rotation and its code, for one dimension; equal for equal parameters."""

    def __init__(self, dim: int, turn: int = 0, codes: int = CODES, cap: float | None = None):
        rng = np.random.default_rng([SEED, dim, turn, codes])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.parts = [p for p in np.array_split(np.arange(dim), BLOCKS) if len(p)]
        self.codes = []
        for p in self.parts:  # few dimensions have few directions to tell apart
            c = rng.standard_normal((min(codes, 2 * 4 ** min(len(p) - 1, 8)) // 2, len(p)))
            c = np.concatenate([c, -c])
            self.codes.append(c / np.linalg.norm(c, axis=1)[:, None] / np.sqrt(len(self.parts)))
        self.cap, self.size = cap_cosine(dim) if cap is None else cap, codes

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter that a row of unit vectors exceeds, by row then filter.

        Partial sums over the first blocks go on only where the best code of the
        blocks to come could still lift them over the cap. Directions almost as
        close as the closest count as exceeded, so that every row has some.
        """
        turned = unit @ self.rotation
        scores = [turned[:, p] @ c.T for p, c in zip(self.parts, self.codes, strict=True)]
        best = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]
        cap = np.minimum(self.cap, 0.98 * best[0])
        row, at, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for k, s in enumerate(scores):
            rest = best[k + 1] if k + 1 < len(scores) else np.zeros(len(unit))
            sums = total[:, None] + s[row]
            keep, code = np.nonzero(sums >= (cap - rest)[row][:, None])
            total, at, row = sums[keep, code], at[keep] * self.size + code, row[keep]
        return row, at


def unit_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision and their norms, from a list column of equal lengths without nulls."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    x = flat.reshape(len(vectors), -1)
    scale = np.abs(x).max(axis=1)
    x = x / scale[:, None]
    norm = np.sqrt((x * x).sum(axis=1))
    return x / norm[:, None], norm


def _directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each vector the sorted list of its filters over all rotations."""
    codes: dict[int, list[ProductCode]] = {}
    for batch in batches:
        size = batch.column("size").to_numpy()
        for dim in np.unique(size):
            own = batch.filter(pa.array(size == dim))
            turns = codes.setdefault(int(dim), [ProductCode(int(dim), t) for t in range(ROTATIONS)])
            for i in range(0, own.num_rows, 256):
                part = own.slice(i, 256)
                unit = unit_rows(part.column("vector"))[0]
                got = [code.decode(unit) for code in turns]
                row = np.concatenate([r for r, _ in got])
                at = np.concatenate([a + t * CODES**BLOCKS for t, (_, a) in enumerate(got)])
                order = np.lexsort((at, row))
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=part.num_rows))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "filters"])


def _shared_before(filters: list[np.ndarray], at: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether rows ``first`` and ``second`` share a filter smaller than ``at``."""
    lower = [f[f < at] for f in filters]
    flat = np.concatenate(lower) if lower else np.empty(0, np.int64)
    kinds, code = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(lower)), [len(x) for x in lower])
    often = np.bincount(code, minlength=len(kinds)) > 1
    slot = np.cumsum(often) - 1
    table = np.zeros((len(filters), int(often.sum())), np.float32)
    sel = often[code]
    table[owner[sel], slot[code[sel]]] = 1
    return (table[first] @ table[second].T) > 0


def _prepare(table: pa.Table) -> dict:
    filters = table.column("filters").combine_chunks()
    sizes = table.column("size").to_numpy()
    out = {n: table.column(n).to_numpy() for n in ("vec_id", "copies", "filter")} | {"flat": filters.flatten().to_numpy(), "ends": np.append(0, np.cumsum(filters.value_lengths().to_numpy()))}
    vectors = table.column("vector").combine_chunks()
    out["unit"], out["size"] = {}, sizes
    out["place"] = np.zeros(len(sizes), np.int64)
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        out["place"][at] = np.arange(len(at))
        out["unit"][int(n)] = unit_rows(vectors.take(pa.array(at)))[0]
    return out


def _compare(prepared: dict, rows: slice, second: np.ndarray | None) -> dict[str, np.ndarray] | None:
    place = prepared["place"][rows.start]
    unit = prepared["unit"][int(prepared["size"][rows.start])][place : place + rows.stop - rows.start]
    a, b = (slice(None), slice(None)) if second is None else (~second, second)
    near = unit[a] @ unit[b].T >= THRESHOLD
    if second is None:
        np.fill_diagonal(near, False)
    if not near.any():
        return None
    ids, copies, ends = prepared["vec_id"][rows], prepared["copies"][rows], prepared["ends"][rows.start : rows.stop + 1]
    first, other = np.arange(len(ids))[a], np.arange(len(ids))[b]
    filters = [prepared["flat"][i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
    new = near & ~_shared_before(filters, int(prepared["filter"][rows.start]), first, other)
    links = np.zeros(len(ids), np.int64)
    links[first] += new @ copies[other]
    whole = near
    if second is not None:
        links[other] += copies[first] @ new
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[np.ix_(first, other)] = near
        whole[np.ix_(other, first)] = near.T
    src, dst = forest(ids, whole)
    some = np.flatnonzero(links)
    return {"src": np.concatenate([src, ids[some]]), "dst": np.concatenate([dst, ids[some]]), "links": np.concatenate([np.zeros(len(src), np.int64), links[some]])}


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are compared within a label (not null) and a length. Vectors that are
    null, empty, zero, or hold a null or non-finite component, and vectors without
    a label, link with nothing. Equal vectors of a label are one class before any
    comparison and count as links of each other, rows repeated with id and vector too.
    Every row gives a row: an id that stands on several vectors has one for each, with
    the links of that vector. component_id is the smallest id of the linked rows; a
    null id takes no part in links and is its own null component. An empty table gives
    an empty result; other columns are not read.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("long").alias("label"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size(v) > 0, F.lit(False))
    sound &= ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", "label", F.when(sound, F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))).alias("vector"))
    # a class of equal vectors has a number of its own, as ids may stand on several vectors
    grouped = rows.filter("vector IS NOT NULL").groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(grouped.withColumn("class_id", F.monotonically_increasing_id()))
    each = classes.select("label", F.size("vector").cast("long").alias("size"), F.col("class_id").alias("vec_id"), "copies", "vector")
    kind = each.schema["vector"].dataType.simpleString()
    listed = stored(each.mapInArrow(_directions, f"label long, size long, vec_id long, copies long, vector {kind}, filters array<int>"))
    postings = listed.select("label", "size", "vec_id", F.explode("filters").alias("filter"))
    facts = listed.select("vec_id", "copies", "vector", "filters")
    found = stored(compare_blocks(postings, ["label", "size", "filter"], "vec_id", ["copies", "vector", "filters"], _prepare, _compare, "src long, dst long, links long", BLOCK_ROWS, facts))
    parts = connected_components(found.select("src", "dst"))
    links = found.groupBy(F.col("src").alias("class_id")).agg(F.sum("links").alias("links"))
    member = classes.select("class_id", "first_id").join(parts, F.col("class_id") == F.col("node"), "left").select("class_id", "first_id", F.coalesce("component", "class_id").alias("part"))
    least = stored(member.groupBy("part").agg(F.min("first_id").alias("component_id")))
    facts = (
        classes.join(links, "class_id", "left")
        .join(member.join(least, "part").select("class_id", "component_id"), "class_id")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    return rows.join(facts, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of the whole embeddings table."""
    return embedding_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = {
    "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), part AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT p.vec_id, coalesce(n.n_links, 0) AS n_links, p.component_id, p.vec_id = p.component_id AS kept FROM part p LEFT JOIN n USING (vec_id)
"""
}
