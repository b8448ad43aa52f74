"""Feature plans over Arrow batches, for tables of thousands of columns.

Catalyst compiles an expression for every condition of every feature; for a few
features that is the best form, for thousands it never ends. Here a task reads
record batches and evaluates the plan with numpy, column by column. What it finds
out about its rows is a state that merges: counters and the first places of each
condition, moments of each column, rows of each class. Tasks return one state
each, and Spark adds these up.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.plans.feature_plan import FeaturePlan, Node
from broadloom.session import write_read

#: Types of columns that are read as numbers; all others reach a plan as conditions that Spark evaluates.
NUMBERS = (*S.INT_TYPES, *S.FLOAT_TYPES)
_KINDS = {"tinyint": np.int8, "smallint": np.int16, "int": np.int32, "bigint": np.int64, "float": np.float32, "double": np.float64}
#: Rows for each column of a state: conditions, columns, classes of a split, and the table.
CHECK, COLUMN, CLASS = "check", "column", "class"
_PLACE = pa.struct([("source_file", pa.string()), ("row_number", pa.int64()), ("value", pa.string()), ("number", pa.float64()), ("form", pa.int32())])
_STATE = pa.schema(
    [("kind", pa.string()), ("key", pa.int64()), ("name", pa.string()), ("n", pa.int64()), ("nulls", pa.int64()), ("non_finite", pa.int64()), ("not_binary", pa.int64()), ("not_whole", pa.int64())]
    + [(x, pa.float64()) for x in ("low", "high", "mean", "m2")]
    + [("places", pa.list_(_PLACE))]
)
_STATE_DDL = "kind string, key long, name string, n long, nulls long, non_finite long, not_binary long, not_whole long, low double, high double, mean double, m2 double, places array<struct<source_file: string, row_number: long, value: string, number: double, form: int>>"


class Values(NamedTuple):
    """Numbers of one column of a batch, and where they are null (their number is 0 there)."""

    data: np.ndarray
    null: np.ndarray


def values_of(array: pa.Array) -> Values:
    null = np.zeros(len(array), bool) if not array.null_count else ~array.is_valid().to_numpy(zero_copy_only=False)
    if array.null_count:
        array = array.fill_null(0)
    return Values(array.to_numpy(zero_copy_only=False), null)


def _double(x: Values) -> np.ndarray:
    return x.data.astype(np.float64, copy=False)


def cast(x: Values, to: str) -> Values:
    """As scalars.safe_cast: null where a whole number type is overflown or a fraction would be lost."""
    kind = _KINDS[to]
    if to in S.FLOAT_TYPES or x.data.dtype.kind in "iub" and np.can_cast(x.data.dtype, kind):
        with np.errstate(over="ignore"):
            return Values(x.data.astype(kind, copy=False), x.null)
    info = np.iinfo(kind)
    if x.data.dtype.kind == "f":
        whole = np.isfinite(x.data) & (x.data == np.floor(x.data))
        # the largest long is no double: what is below its power of two fits
        fits = whole & (x.data >= float(info.min)) & (x.data < float(info.max) + 1.0 if to == "bigint" else x.data <= float(info.max))
    else:
        fits = (x.data >= info.min) & (x.data <= info.max)
    return Values(np.where(fits, x.data, 0).astype(kind), x.null | ~fits)


def _none(x: Values) -> np.ndarray:
    return np.zeros(len(x.data), bool)


def _cast(x: Values, p: dict) -> tuple[Values, np.ndarray]:
    out = cast(x, p["to"])
    return out, out.null & ~x.null


def _presence(x: Values, p: dict) -> tuple[Values, np.ndarray]:
    return Values((x.data > 0).astype(np.int32), x.null), _none(x)


def _fill(x: Values, p: dict) -> tuple[Values, np.ndarray]:
    data = x.data if isinstance(p["value"], int) or x.data.dtype.kind == "f" else _double(x)
    return Values(np.where(x.null, p["value"], data), _none(x)), _none(x)


def _clip(x: Values, p: dict) -> tuple[Values, np.ndarray]:
    whole = x.data.dtype.kind != "f" and isinstance(p["min"], int) and isinstance(p["max"], int)
    return Values(np.clip(x.data if whole else _double(x), p["min"], p["max"]), x.null), _none(x)


def _log1p(x: Values, p: dict) -> tuple[Values, np.ndarray]:
    d = _double(x)
    failed = ~x.null & (d < 0)
    with np.errstate(invalid="ignore"):
        return Values(np.log1p(np.where(failed, 0, d)), x.null | failed), failed


#: Operations that have a form on arrays: value and where it fails. Nodes of other operations are left to Spark.
OPS: dict[str, Callable[[Values, dict], tuple[Values, np.ndarray]]] = {
    "identity": lambda x, p: (x, _none(x)),
    "cast": _cast,
    "positive_presence": _presence,
    "fill_null": _fill,
    "clip": _clip,
    "log1p_nonnegative": _log1p,
}


class Result(NamedTuple):
    """A node's values after its cast and missing policy, and where the operation failed, the type overflowed, the value was null."""

    value: Values
    failed: np.ndarray
    overflow: np.ndarray
    null: np.ndarray


def on_arrays(plan: FeaturePlan, kinds: dict[str, str]) -> list[Node]:
    """The nodes that arrays can express: known operations and number types all the way up to number columns."""
    good: dict[str, Node] = {}
    for n in plan.order:
        above = kinds.get(n.column) in NUMBERS if n.input is None else n.input in good
        if above and n.op in OPS and n.type in NUMBERS and (n.op != "cast" or n.params["to"] in NUMBERS):
            good[n.id] = n
    return list(good.values())


def evaluate(nodes: list[Node], columns: dict[str, Values]) -> Iterator[tuple[Node, Result]]:
    """Results of the nodes in order; a node that others read is computed once."""
    done: dict[str, Values] = {}
    read = {n.input for n in nodes if n.input is not None}
    for n in nodes:
        value, failed = OPS[n.op](columns[n.column] if n.input is None else done[n.input], n.params)
        out = cast(value, n.type)
        overflow = out.null & ~value.null
        null = value.null & ~failed
        if n.missing == "constant":
            out = Values(np.where(out.null, np.asarray(n.constant).astype(_KINDS[n.type]), out.data), _none(out))
        if n.id in read:
            done[n.id] = out
        yield n, Result(out, failed, overflow, null)


def node_checks(n: Node, output: bool, unit_interval: bool = False) -> list[tuple[str, str, Callable[[Result], np.ndarray]]]:
    """(code, stage, condition) of a node; those of outputs hold the conditions on model input too."""
    out: list[tuple] = [("TYPE_OVERFLOW", "type", lambda r: r.overflow), ("TRANSFORM_FAILED", "transform", lambda r: r.failed)]
    if n.missing == "error":
        out.append(("UNHANDLED_NULL" if n.input is None else "NULL_POLICY", "null", lambda r: r.null))

    def finite(r: Result) -> np.ndarray:
        return ~r.value.null if r.value.data.dtype.kind != "f" else ~r.value.null & np.isfinite(r.value.data)

    out.append(("NON_FINITE", "value", lambda r: ~r.value.null & ~finite(r)))
    low, high = n.low, n.high
    if n.kind == "binary":
        out.append(("BINARY_DOMAIN", "value", lambda r: finite(r) & (r.value.data != 0) & (r.value.data != 1)))
        low, high = (None if low in (None, 0) else low), (None if high in (None, 1) else high)
    if low is not None:
        out.append(("RANGE_MIN", "value", lambda r: finite(r) & (r.value.data < low)))
    if high is not None:
        out.append(("RANGE_MAX", "value", lambda r: finite(r) & (r.value.data > high)))
    if n.allowed:
        out.append(("CATEGORY_DOMAIN", "value", lambda r: ~r.value.null & ~np.isin(r.value.data, n.allowed)))
    if output:

        def single(r: Result) -> np.ndarray:
            with np.errstate(over="ignore"):
                return _double(r.value).astype(np.float32)

        out.append(("TENSOR_NON_FINITE", "tensor", lambda r: ~r.value.null & ~np.isfinite(single(r))))
        if n.type in S.INT_TYPES:
            out.append(("TENSOR_PRECISION", "tensor", lambda r: ~r.value.null & (single(r).astype(np.float64) != _double(r.value))))
        if unit_interval:
            out.append(("MODEL_DOMAIN", "tensor", lambda r: ~r.value.null & ~((single(r) >= 0) & (single(r) <= 1))))
    return out


#: How a value travels: as text, or as the number of a double or float, which Spark turns into text.
TEXT, DOUBLE, FLOAT = 0, 1, 2


def _form(kind: np.dtype) -> int:
    return TEXT if kind.kind != "f" else FLOAT if kind.itemsize == 4 else DOUBLE


def _shown(value: Column, number: Column, form: Column) -> Column:
    return F.when(form == DOUBLE, number.cast("string")).when(form == FLOAT, number.cast("float").cast("string")).otherwise(value)


class _Moments:
    """Counts, extremes, mean and squares about it of a column's finite numbers; batches are merged pairwise."""

    __slots__ = ("high", "low", "m2", "mean", "n", "non_finite", "not_binary", "not_whole", "nulls", "rows")

    def __init__(self):
        self.rows = self.nulls = self.non_finite = self.not_binary = self.not_whole = self.n = 0
        self.low, self.high, self.mean, self.m2 = np.inf, -np.inf, 0.0, 0.0

    def add(self, x: Values) -> None:
        self.rows += len(x.data)
        data = x.data[~x.null] if x.null.any() else x.data
        self.nulls += len(x.data) - len(data)
        self.not_binary += len(data) - int(np.count_nonzero((data == 0) | (data == 1)))
        if data.dtype.kind == "f":
            finite = np.isfinite(data)
            if not finite.all():
                self.non_finite += len(data) - int(np.count_nonzero(finite))
                data = data[finite]
            data = data.astype(np.float64, copy=False)
            self.not_whole += int(np.count_nonzero(data != np.floor(data)))
        n = len(data)
        if not n:
            return
        self.low, self.high = min(self.low, float(data.min())), max(self.high, float(data.max()))
        data = data.astype(np.float64, copy=False)
        mean = float(data.mean())
        apart = data - mean
        delta = mean - self.mean
        with np.errstate(over="ignore"):
            self.m2 += float(apart @ apart) + delta * delta * self.n * n / (self.n + n)
        self.mean += delta * n / (self.n + n)
        self.n += n


class _Scan:
    """The state of one task."""

    def __init__(self, conditions: int, columns: list[str], nodes: list[Node], outputs: set[str], unit_interval: bool, examples: int, moments: list[str]):
        self.conditions, self.columns, self.nodes, self.examples = conditions, columns, nodes, examples
        number = itertools.count(conditions)
        self.checks = {n.id: [(next(number), c[2]) for c in node_checks(n, n.id in outputs, unit_interval)] for n in nodes}
        self.moments = {c: _Moments() for c in moments}
        self.found: dict[int, int] = {}
        self.places: dict[int, list[tuple]] = {}
        self.classes: dict[str, int] = {}

    def _meet(self, check: int, mask: np.ndarray, batch: pa.RecordBatch, rank: Callable[[], np.ndarray], shown: Callable[[int], tuple]) -> None:
        n = int(np.count_nonzero(mask))
        if not n:
            return
        self.found[check] = self.found.get(check, 0) + n
        if self.examples:
            at = np.flatnonzero(mask)
            if n > self.examples:
                at = at[np.argpartition(rank()[at], self.examples - 1)[: self.examples]]
            files, numbers = batch.column("source_file"), batch.column("row_number")
            new = [(files[int(i)].as_py(), numbers[int(i)].as_py(), *shown(int(i))) for i in at]
            held = self.places.get(check, []) + new
            self.places[check] = sorted(held, key=lambda p: (p[0] is not None, p[0] or "", p[1] is not None, p[1] or 0))[: self.examples]

    def add(self, batch: pa.RecordBatch) -> None:
        rank = _lazy(lambda: _ranks(batch))
        names = batch.schema.names
        if self.conditions:
            met = batch.column("met")
            flags = met.flatten().fill_null(False).to_numpy(zero_copy_only=False).reshape(batch.num_rows, self.conditions)
            texts = batch.column("shown") if self.examples else None
            for k in np.flatnonzero(flags.any(axis=0)):
                self._meet(int(k), flags[:, k], batch, rank, lambda i, k=k: (texts[i][int(k)].as_py(), None, TEXT))
        if "split" in names:
            for pair, n in zip(*np.unique(np.array([f"{s}\0{y}" for s, y in zip(batch.column("split").to_pylist(), batch.column("label").to_pylist(), strict=True)]), return_counts=True), strict=True) if batch.num_rows else ():
                self.classes[str(pair)] = self.classes.get(str(pair), 0) + int(n)
        values = {c: values_of(batch.column(f"c{k}")) for k, c in enumerate(self.columns)}
        for c, m in self.moments.items():
            m.add(values[c])
        for n, result in evaluate(self.nodes, values):
            for check, condition in self.checks[n.id]:
                self._meet(check, condition(result), batch, rank, lambda i, r=result: _carried(r.value, i))

    def rows(self) -> pa.RecordBatch:
        out = [(CHECK, k, None, n, *[None] * 8, [dict(zip(("source_file", "row_number", "value", "number", "form"), p, strict=True)) for p in self.places.get(k, [])]) for k, n in self.found.items()]
        for k, (c, m) in enumerate(self.moments.items()):
            some = m.n > 0
            out.append((COLUMN, k, c, m.rows, m.nulls, m.non_finite, m.not_binary, m.not_whole, m.low if some else None, m.high if some else None, m.mean if some else None, m.m2 if some else None, []))
        out += [(CLASS, None, pair, n, *[None] * 8, []) for pair, n in self.classes.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out, strict=True)), _STATE.types, strict=True)] if out else [pa.array([], t) for t in _STATE.types], schema=_STATE)


def _carried(x: Values, i: int) -> tuple:
    form = _form(x.data.dtype)
    if x.null[i]:
        return None, None, form
    return (str(int(x.data[i])), None, form) if form == TEXT else (None, float(x.data[i]), form)


def _lazy(make: Callable[[], np.ndarray]) -> Callable[[], np.ndarray]:
    held: list[np.ndarray] = []

    def get() -> np.ndarray:
        if not held:
            held.append(make())
        return held[0]

    return get


def _ranks(batch: pa.RecordBatch) -> np.ndarray:
    """The rank of each row by file and row number, nulls first."""
    by = pa.table({"f": batch.column("source_file"), "r": batch.column("row_number")})
    order = pa.compute.sort_indices(by, sort_keys=[("f", "ascending"), ("r", "ascending")], null_placement="at_start").to_numpy()
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def scan(
    df: DataFrame, plan: FeaturePlan | None = None, conditions: list[tuple[str, str, str, str, Column]] = (), unit_interval: bool = False, examples: int = 0, moments: list[str] = (), classes: tuple[str, str] | None = None
) -> tuple[DataFrame, list[tuple[str, str, str, str]]]:
    """(state rows, checks by number), from one scan of ``df``.

    ``conditions`` are Columns of ``df`` (severity, code, stage, feature, condition);
    they get the first numbers. ``moments`` names number columns to sum up, ``classes``
    a split and a label column whose rows are counted. Nodes whose operation or types
    have no array form (see on_arrays) are not checked here. The state is stored, so
    that what is derived from it does not scan again. An empty table has no state.
    """
    kinds = dict(df.dtypes)
    nodes = on_arrays(plan, kinds) if plan else []
    listed = [c[:4] for c in conditions]
    outputs = set(plan.outputs) if plan else set()
    listed += [("error", code, stage, n.id) for n in nodes for code, stage, _ in node_checks(n, n.id in outputs, unit_interval)]
    columns = list(dict.fromkeys([*(n.column for n in nodes if n.column is not None), *moments]))
    names = {c.lower() for c in df.columns}
    picked = [(F.col(c) if c in names else F.lit(None)).cast(t).alias(c) for c, t in (("source_file", "string"), ("row_number", "long"))]
    if conditions:
        picked.append(F.array(*[c[4] for c in conditions]).alias("met"))
        if examples:
            shown = [c[3].replace("@", "_v").replace(".", "_") if c[3] else "" for c in conditions]
            picked.append(F.array(*[(F.col(f"`{c}`") if c.lower() in names else F.lit(None)).cast("string") for c in shown]).alias("shown"))
    if classes:
        picked += [F.col(classes[0]).cast("string").alias("split"), F.col(classes[1]).cast("string").alias("label")]
    picked += [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]
    arguments = (len(conditions), columns, nodes, outputs, unit_interval, examples, list(moments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = _Scan(*arguments), 0
        for batch in batches:
            seen += batch.num_rows
            state.add(batch)
        if seen:
            yield state.rows()

    return write_read(df.select(*picked).mapInArrow(run, _STATE_DDL)), listed


def check_counts(state: DataFrame, listed: list[tuple[str, str, str, str]], examples: int = 0) -> DataFrame:
    """(severity, code, stage, feature, count), with ``examples`` also the first so many places as ``file:row:value``."""
    names = state.sparkSession.createDataFrame([(k, *c) for k, c in enumerate(listed)], "check long, severity string, code string, stage string, feature string")
    found = state.filter(F.col("kind") == CHECK)
    place = F.struct("p.source_file", "p.row_number", _shown(F.col("p.value"), F.col("p.number"), F.col("p.form")).alias("value"))
    out = found.groupBy(F.col("key").alias("check")).agg(F.sum("n").alias("count"))
    out = out.join(F.broadcast(names), "check")  # a row for each check of the contract
    if not examples:
        return out.select("severity", "code", "stage", "feature", "count")
    # every task has cut its places already; sorted arrays of (null first) places are cut again
    some = found.select(F.col("key").alias("check"), F.explode("places").alias("p")).groupBy("check").agg(F.slice(F.array_sort(F.collect_list(place)), 1, examples).alias("p"))
    text = F.transform("p", lambda x: F.concat_ws(":", x["source_file"], x["row_number"], F.coalesce(x["value"], F.lit("null"))))
    return out.join(some.select("check", text.alias("examples")), "check", "left").select("severity", "code", "stage", "feature", "count", "examples")


def moments_of(state: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each of the scan's columns: row_count, null_count, non_finite, not_binary, not_whole, finite, and low, high, mean, m2 of finite values.

    Columns of an empty table have counts of 0. Parts are merged by their means: squares about a part's mean, and that mean's distance from the whole's.
    """
    none = state.sparkSession.createDataFrame([(COLUMN, k, c, 0, 0, 0, 0, 0, None, None, None, None, []) for k, c in enumerate(columns)], _STATE_DDL)
    part = state.filter(F.col("kind") == COLUMN).unionByName(none).withColumn("finite", F.col("n") - F.col("nulls") - F.col("non_finite"))
    total = part.groupBy("key", "name").agg(
        F.sum("n").alias("row_count"), F.sum("nulls").alias("null_count"), F.sum("non_finite").alias("non_finite"), F.sum("not_binary").alias("not_binary"), F.sum("not_whole").alias("not_whole"),
        F.sum("finite").alias("finite"), F.min("low").alias("low"), F.max("high").alias("high"), (F.sum(F.col("finite") * F.col("mean")) / F.nullif(F.sum("finite"), F.lit(0))).alias("mean"),
    )
    squares = part.select("key", "finite", F.col("mean").alias("own"), "m2").join(total.select("key", "mean"), "key").groupBy("key").agg(F.sum(F.col("m2") + F.col("finite") * F.pow(F.col("own") - F.col("mean"), 2)).alias("m2"))
    return total.join(squares, "key").drop("key").withColumnRenamed("name", "column_name")


def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """moments_of() any columns in one scan; of columns that are no numbers only nulls are counted."""
    kinds = dict(df.dtypes)
    narrow = df.select(*[F.col(f"`{c}`") if kinds[c] in NUMBERS else F.when(F.col(f"`{c}`").isNotNull(), F.lit(0)).alias(c) for c in columns])
    return moments_of(scan(narrow, moments=columns)[0], columns)


def class_rows(state: DataFrame) -> DataFrame:
    """(split, label, n), both as text ('None' for null)."""
    pair = F.split("name", "\0")
    return state.filter(F.col("kind") == CLASS).groupBy("name").agg(F.sum("n").alias("n")).select(pair[0].alias("split"), pair[1].alias("label"), "n")


def _kept(df: DataFrame, keep: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in keep)


def sparse_features(df: DataFrame, plan: FeaturePlan, keep: list[str]) -> DataFrame:
    """``keep`` with the plan's outputs as a sparse row: indices array<int>, ascending, and values array<float>, none of them 0.

    An output that is null is an error: a contract lets none through. All of the plan's nodes must have an array form.
    """
    nodes = on_arrays(plan, dict(df.dtypes))
    if left := {n.id for n in plan.order} - {n.id for n in nodes}:
        raise ValueError(f"no array form: {sorted(left)[:5]}")
    columns = list(dict.fromkeys(n.column for n in nodes if n.column is not None))
    place = {ref: k for k, ref in enumerate(plan.outputs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {c: values_of(batch.column(len(keep) + k)) for k, c in enumerate(columns)}
            rows, at, data = [], [], []
            for n, result in evaluate(nodes, values):
                if n.id in place:
                    if result.value.null.any():
                        raise ValueError(f"null in the output {n.id}")
                    some = np.flatnonzero(result.value.data)
                    rows.append(some)
                    at.append(np.full(len(some), place[n.id], np.int32))
                    data.append(_double(result.value)[some].astype(np.float32))
            row, index, value = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (rows, at, data))
            order = np.lexsort((index, row))
            ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(index[order], pa.int32())), pa.ListArray.from_arrays(ends, pa.array(value[order], pa.float32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *lists], [*keep, "indices", "values"])

    picked = df.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(columns)])
    return picked.mapInArrow(run, _kept(df, keep) + ", indices array<int>, values array<float>")


def counted_values(df: DataFrame, numbers: list[str], texts: list[str], held: int = 500_000) -> DataFrame:
    """(column_name, value, number, n) of values in each task: partial counts of number columns and of text columns.

    A task keeps a map for each column and hands its counts on whenever these maps
    hold ``held`` values, so columns of many values cost no more memory than others.
    """
    schema = pa.schema([("column_name", pa.string()), ("value", pa.string()), ("number", pa.float64()), ("form", pa.int32()), ("n", pa.int64())])
    kinds = dict(df.dtypes)
    forms = {c: _form(np.dtype(_KINDS[kinds[c]])) for c in numbers}

    def rows(maps: dict[str, dict]) -> Iterator[pa.RecordBatch]:
        cells = ((c, v, n) for c, counts in maps.items() for v, n in counts.items())
        while some := list(itertools.islice(cells, 50_000)):
            form = [forms.get(c, TEXT) for c, _, _ in some]
            number = [None if v is None or c not in forms else float(v) for c, v, _ in some]
            value = [None if v is None or f != TEXT else str(v) for (_, v, _), f in zip(some, form, strict=True)]
            columns = [[c for c, _, _ in some], value, number, form, [n for _, _, n in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[str, dict] = {c: {} for c in (*numbers, *texts)}
        size = 0
        for batch in batches:
            for k, (c, counts) in enumerate(maps.items()):
                column = batch.column(k)
                if column.null_count:
                    counts[None] = counts.get(None, 0) + column.null_count
                    column = column.drop_null()
                size -= len(counts)
                if k < len(numbers):
                    data = column.to_numpy(zero_copy_only=False)
                    if data.dtype.kind == "f":
                        data = data + data.dtype.type(0)  # one zero
                    found, often = np.unique(data, return_counts=True)
                    for v, n in zip(found, often.tolist(), strict=True):
                        key = v if v == v else "nan"  # one key for all
                        counts[key] = counts.get(key, 0) + n
                else:
                    for pair in column.value_counts():
                        v = pair["values"].as_py()
                        counts[v] = counts.get(v, 0) + pair["counts"].as_py()
                size += len(counts)
            if size >= held:
                yield from rows(maps)
                maps, size = {c: {} for c in maps}, 0
        yield from rows(maps)

    picked = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(numbers)], *[F.col(f"`{c}`").cast("string").alias(f"t{k}") for k, c in enumerate(texts)])
    parts = picked.mapInArrow(run, "column_name string, value string, number double, form int, n long")
    return parts.withColumn("value", _shown(F.col("value"), F.col("number"), F.col("form"))).drop("form")
