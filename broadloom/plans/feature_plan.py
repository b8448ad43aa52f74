"""Declared feature graphs, compiled to one chain of Column projections."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.functions import scalars as S

#: Columns that must not become features.
FORBIDDEN = ("label", "hash", "family", "vt_count", "split_name", "dataset_id", "config_name", "source_file", "row_number")

#: op -> (required parameters, value, failure). Failure tells where a value that is not null is lost.
OPS: dict[str, tuple[tuple[str, ...], Callable[[Column, dict], Column], Callable[[Column, dict], Column]]] = {}
_NEVER = lambda x, p: F.lit(False)


#: op -> how two implementations of it may differ: exactly equal, or numbers within a relative tolerance.
EQUIVALENCE: dict[str, float] = {}
#: model_ref -> a function from a column to scores; a reference is bound once.
MODELS: dict[str, Callable[[Column], Column]] = {}


def register(op: str, params: tuple[str, ...], value: Callable[[Column, dict], Column], failed: Callable[[Column, dict], Column] = _NEVER, tolerance: float = 0.0) -> None:
    """Adds an operation; an operation that exists cannot be replaced. ``tolerance`` is its equivalence policy."""
    if op in OPS:
        raise ValueError(f"operation exists: {op}")
    if tolerance < 0:
        raise ValueError(f"{op}: the tolerance is negative")
    OPS[op], EQUIVALENCE[op] = (params, value, failed), tolerance


def register_model(ref: str, score: Callable[[Column], Column]) -> None:
    """Binds a model reference (name@version) to a scorer, for good."""
    if "@" not in ref:
        raise ValueError(f"no version: {ref}")
    if ref in MODELS:
        raise ValueError(f"the reference is bound: {ref}")
    MODELS[ref] = score


def not_equivalent(df: DataFrame, op: str, params: dict, column: str, other: Callable[[Column, dict], Column]) -> DataFrame:
    """Rows of ``df`` where another implementation of an operation breaks its equivalence policy: null against a value, or too far."""
    a, b = OPS[op][1](F.col(column), params), other(F.col(column), params)
    far = ~a.eqNullSafe(b)
    if EQUIVALENCE[op]:
        near = F.abs(a - b) <= EQUIVALENCE[op] * F.greatest(F.abs(a), F.abs(b))
        far &= ~F.coalesce(near, F.lit(False))
    return df.filter(far)


register("identity", (), lambda x, p: x)
register("cast", ("to",), lambda x, p: S.safe_cast(x, p["to"]), lambda x, p: S.cast_failed(x, p["to"]))
register("positive_presence", (), lambda x, p: S.presence(x))
register("fill_null", ("value",), lambda x, p: S.fill_null(x, p["value"]))
register("clip", ("min", "max"), lambda x, p: S.clip(x, p["min"], p["max"]))
register("log1p_nonnegative", (), lambda x, p: S.log1p_nonnegative(x), lambda x, p: S.log1p_failed(x), 1e-12)
register("model", ("model_ref",), lambda x, p: MODELS[p["model_ref"]](x), tolerance=1e-9)
register("stable_hash", ("seed", "num_buckets", "null_bucket"), lambda x, p: S.stable_hash_bucket(x.cast("string"), p["seed"], p["num_buckets"], p["null_bucket"]))


@dataclass(frozen=True)
class Node:
    """A feature ``id`` (name@version): raw if it has a column, else derived from one input by an operation."""

    id: str
    column: str | None = None
    source: str | None = None
    input: str | None = None
    op: str = "identity"
    params: dict = field(default_factory=dict)
    type: str = "float"
    missing: str = "propagate"  # error, propagate or constant
    constant: float | None = None
    kind: str = "numerical"  # binary, numerical, categorical
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()

    @property
    def name(self) -> str:
        return self.id.replace("@", "_v").replace(".", "_")


@dataclass(frozen=True)
class FeaturePlan:
    """Ordered nodes and outputs of a compiled graph."""

    order: tuple[Node, ...]
    outputs: tuple[str, ...]

    @classmethod
    def compile(cls, nodes: list[Node], outputs: list[str]) -> FeaturePlan:
        """Resolves references and orders nodes; errors for repeated or missing ids, cycles, unknown
        operations, absent parameters, forbidden columns and inputs from several sources."""
        by_id: dict[str, Node] = {}
        for n in nodes:
            if n.id in by_id:
                raise ValueError(f"duplicate feature: {n.id}")
            if "@" not in n.id:
                raise ValueError(f"no version: {n.id}")
            if (n.column is None) == (n.input is None):
                raise ValueError(f"{n.id}: either a column or one input")
            if n.column in FORBIDDEN:
                raise ValueError(f"{n.id}: forbidden column {n.column}")
            if n.op not in OPS:
                raise ValueError(f"{n.id}: unknown operation {n.op}")
            if absent := [p for p in OPS[n.op][0] if p not in n.params]:
                raise ValueError(f"{n.id}: parameters missing: {absent}")
            if n.op == "model" and n.params["model_ref"] not in MODELS:
                raise ValueError(f"{n.id}: unknown model {n.params['model_ref']}")
            if n.missing == "constant" and n.constant is None:
                raise ValueError(f"{n.id}: no constant")
            by_id[n.id] = n
        order: list[Node] = []
        state: dict[str, int] = {}

        def visit(ref: str) -> None:
            if ref not in by_id:
                raise ValueError(f"missing feature: {ref}")
            if state.get(ref) == 1:
                raise ValueError(f"cycle at {ref}")
            if ref not in state:
                state[ref] = 1
                if by_id[ref].input is not None:
                    visit(by_id[ref].input)
                state[ref] = 2
                order.append(by_id[ref])

        for ref in outputs:
            visit(ref)
        if len({n.source for n in order if n.column is not None}) > 1:
            raise ValueError("features of several sources in one plan")
        return cls(tuple(order), tuple(outputs))

    def required(self) -> list[str]:
        """Physical columns that the plan reads."""
        return list(dict.fromkeys(n.column for n in self.order if n.column is not None))

    @functools.cached_property
    def by_id(self) -> dict[str, Node]:
        return {n.id: n for n in self.order}

    def node(self, ref: str) -> Node:
        return self.by_id[ref]

    def depth(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for n in self.order:
            out[n.id] = 0 if n.input is None else out[n.input] + 1
        return out

    def apply(self, df: DataFrame, keep: list[str], checks: bool = False) -> DataFrame:
        """``keep`` and the outputs, in order. One projection per level of the graph; a shared node is computed once.

        With ``checks`` each node ``n`` also leaves ``n__failed`` and ``n__null`` (null before the missing policy).
        """
        depth = self.depth()
        levels: list[list[Node]] = [[] for _ in range(1 + max(depth.values(), default=0))]
        for n in self.order:
            levels[depth[n.id]].append(n)
        for nodes in levels:
            new: dict[str, Column] = {}
            for n in nodes:
                source = F.col(n.column) if n.input is None else F.col(self.node(n.input).name)
                value = OPS[n.op][1](source, n.params)
                cast = value.cast("double").cast(n.type) if n.type in S.FLOAT_TYPES else S.safe_cast(value, n.type)
                if checks:
                    new[f"{n.name}__failed"] = F.coalesce(OPS[n.op][2](source, n.params), F.lit(False))
                    new[f"{n.name}__overflow"] = value.isNotNull() & cast.isNull()
                    new[f"{n.name}__null"] = value.isNull() & ~F.coalesce(OPS[n.op][2](source, n.params), F.lit(False))
                new[n.name] = F.coalesce(cast, F.lit(n.constant).cast(n.type)) if n.missing == "constant" else cast
            df = df.withColumns(new)
        extra = [f"{n.name}__{x}" for n in self.order for x in ("failed", "overflow", "null")] if checks else []
        outputs = set(self.outputs)
        return df.select(*keep, *[self.node(o).name for o in self.outputs], *[n.name for n in self.order if checks and n.id not in outputs], *extra)

    def edges(self, spark: SparkSession) -> DataFrame:
        """(feature, parent): a parent is an input feature or, for raw nodes, ``source.column``."""
        rows = [(n.id, n.input if n.input is not None else f"{n.source}.{n.column}") for n in self.order]
        return spark.createDataFrame(rows, "feature string, parent string")


def lineage(spark: SparkSession, edges: DataFrame, outputs: list[str]) -> DataFrame:
    """(output, node, depth): every ancestor of each output down to raw columns, by a recursive query."""
    view = f"lineage_{uuid.uuid4().hex}"  # lineages of a session are read lazily, each from its own edges
    edges.createOrReplaceTempView(view)
    listed = ", ".join("'" + o.replace("'", "''") + "'" for o in outputs)
    return spark.sql(f"""
        WITH RECURSIVE chain(output, node, depth) AS (
          SELECT feature, parent, 1 FROM {view} WHERE feature IN ({listed})
          UNION ALL SELECT c.output, e.parent, c.depth + 1 FROM chain c JOIN {view} e ON e.feature = c.node
        ) SELECT output, node, depth FROM chain""")


def presence_nodes(columns: list[str], source: str) -> list[Node]:
    """A raw count and its presence for every column."""
    nodes = []
    for c in columns:
        nodes += [Node(f"{c}.count@1", column=c, source=source, type="bigint"), Node(f"{c}.presence@1", input=f"{c}.count@1", op="positive_presence", type="float", kind="binary", missing="error")]
    return nodes
