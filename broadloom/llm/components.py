"""Links inside posting lists, and connected components, without a list of all pairs.

A posting list is the group of rows that share a key. Lists are cut into blocks
of bounded size, every two blocks of a list meet in one task, and a task gives
the links back as a spanning forest: at most one edge for each row it read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import arrow_groups, drop_stored, stored


def block_pairs(postings: DataFrame, keys: list[str], member: str, block_rows: int) -> DataFrame:
    """Rows of lists with two members or more, once for each pair of blocks they take part in.

    Adds ``block_lo``, ``block_hi`` (the pair) and ``in_hi`` (whether the row is of
    the second block). A list of up to ``block_rows`` rows is one block, paired with
    itself; a longer list of k blocks gives k(k+1)/2 tasks' worth of bounded groups.
    """
    # stored, so that the join has a shuffle of its own on both sides and a long list can be split in it
    sizes = stored(postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("list_rows")).filter("list_rows > 1"))
    blocks = F.ceil(F.col("list_rows") / block_rows).cast("int")
    return (
        postings.join(sizes, keys)
        .withColumn("block", F.pmod(F.xxhash64(member), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("block_lo", F.least("block", "other"))
        .withColumn("block_hi", F.greatest("block", "other"))
        .withColumn("in_hi", (F.col("block") > F.col("other")).cast("int"))
        .drop("list_rows", "block", "other")
    )


def compare_blocks(
    postings: DataFrame,
    keys: list[str],
    member: str,
    payload: list[str],
    prepare: Callable[[pa.Table], dict],
    compare: Callable[[dict, slice, np.ndarray | None], dict[str, np.ndarray] | None],
    schema: str,
    block_rows: int,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Runs ``compare(prepared, rows, second)`` over every pair of blocks; it returns columns of result rows or None.

    ``prepare`` turns the table of many lists into arrays once; ``rows`` is the slice of one pair. Wide ``facts`` (one row per member) are joined only to rows of lists of two or more.

    ``second`` is None where a block meets itself, else the mask of rows of the second block.
    """
    order = [*keys, "block_lo", "block_hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in arrow_groups(batches, order):
            lo, hi, in_hi = (table.column(c).to_numpy() for c in ("block_lo", "block_hi", "in_hi"))
            prepared = prepare(table)
            out: dict[str, list] = {}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a > 1:
                    second = None if lo[a] == hi[a] else in_hi[a:b].astype(bool)
                    if second is not None and (second.all() or not second.any()):
                        continue
                    for k, v in (compare(prepared, slice(a, b), second) or {}).items():
                        out.setdefault(k, []).append(v)
            if out:
                yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})

    rows = block_pairs(postings, keys, member, block_rows)
    rows = (rows if facts is None else rows.join(facts, member)).select(*order, "in_hi", member, *payload)
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def forest(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its part) for the parts of the symmetric matrix ``near``."""
    n = len(ids)
    todo = near.any(axis=1)
    source, target = [], []
    for start in np.argsort(ids, kind="stable"):
        if not todo[start]:
            continue
        part = np.zeros(n, dtype=bool)
        part[start] = True
        frontier = [start]
        while len(frontier):
            reached = near[frontier].any(axis=0) & ~part
            part |= reached
            frontier = np.flatnonzero(reached)
        todo &= ~part
        part[start] = False
        source.append(ids[part])
        target.append(np.full(int(part.sum()), ids[start]))
    if not source:
        return np.empty(0, ids.dtype), np.empty(0, ids.dtype)
    return np.concatenate(source), np.concatenate(target)


def _stars(pairs: DataFrame, centre_too: bool, spent: list[DataFrame]) -> DataFrame:
    """From (u, v) rows: every v, and u itself if asked, tied to the smallest of u and its v's.

    The reduced side is stored, so that the join has a shuffle of its own on both sides
    and the rows of a hub can be split in it; it is added to ``spent``.
    """
    least = stored(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    spent.append(least)
    ties = pairs.join(least, "u").filter("v > u" if not centre_too else "v != m").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    if centre_too:
        ties = ties.union(least.select(F.col("u").alias("src"), F.col("m").alias("dst")))
    return ties.filter("src != dst").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src long, dst long); component is the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the
    edges no longer change. Every round is stored; groups are only ever reduced
    to their minimum, and the joins back are equi-joins that adaptive execution
    can split. Loops and repeated edges are allowed; null ends are ignored.
    """
    edges = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    now = stored(edges.filter("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    before = digest(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = now.select(F.col("src").alias("u"), F.col("dst").alias("v")).union(now.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        spent = [now]
        large = stored(_stars(both, False, spent))
        down = large.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        after_df = stored(_stars(down, True, spent))
        after = digest(after_df)
        for table in (*spent, large):
            drop_stored(table)
        now = after_df
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
