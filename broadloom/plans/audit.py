"""Contract audit: counted diagnostics per code and feature, certification, staging, observations."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.operators.profile import identity_issues
from broadloom.operators.splits import MONTH
from broadloom.plans.arrays import NUMBERS, check_counts, class_rows, moments_of, on_arrays, scan, sparse_features
from broadloom.plans.feature_plan import FeaturePlan, Node
from broadloom.session import write_read
from broadloom.sources.snapshots import create_once, read_small

ISSUES = "severity string, code string, stage string, feature string, count long"
#: Splits that must hold both classes.
SPLITS = ("train", "test")


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ISSUES)


def schema_issues(df: DataFrame, required: list[str], metadata: dict[str, str]) -> DataFrame:
    """MISSING_COLUMN, DUPLICATE_COLUMN and METADATA_TYPE rows from the schema alone."""
    spark, names, kinds = df.sparkSession, df.columns, dict(df.dtypes)
    rows = [("error", "MISSING_COLUMN", "schema", c, 1) for c in [*required, *metadata] if c not in names]
    rows += [("error", "DUPLICATE_COLUMN", "schema", c, names.count(c)) for c in sorted(set(names)) if names.count(c) > 1]
    rows += [("error", "METADATA_TYPE", "schema", c, 1) for c, t in metadata.items() if c in names and not kinds[c].startswith(t)]
    return _rows(spark, rows)


def violations(df: DataFrame, checks: list[tuple[str, str, str, str, Column]], value: bool = False) -> DataFrame:
    """(check, source_file, row_number, value): a row for each condition that a row of ``df`` meets, by number of the check.

    All conditions are read off one scan; null conditions are false. ``value`` is the
    text of the feature's column, if asked for and there is one; places are null
    where the table has none.
    """
    names = {c.lower() for c in df.columns}
    shown = lambda f: F.col(f).cast("string") if value and f is not None and f.lower() in names else F.lit(None).cast("string")
    met = [F.when(c[4], F.struct(F.lit(k).alias("check"), shown(c[3].replace("@", "_v").replace(".", "_") if c[3] else None).alias("value"))) for k, c in enumerate(checks)]
    place = [F.col(c) if c in names else F.lit(None).alias(c) for c in ("source_file", "row_number")]
    return df.select(*place, F.explode(F.array_compact(F.array(*met))).alias("x")).select("x.check", "source_file", "row_number", "x.value")


def count_checks(df: DataFrame, checks: list[tuple[str, str, str, str, Column]], examples: int = 0) -> DataFrame:
    """Counts rows for each (severity, code, stage, feature, condition); keeps those that occur.

    One scan whatever the number of conditions: a row sends on the numbers of those it
    meets, which are counted in each task before the shuffle. With ``examples`` a second
    scan adds the first so many places of each, as ``file:row:value``; ranks are cut in
    each task too.
    """
    if not checks:
        return _rows(df.sparkSession, [])
    listed = df.sparkSession.createDataFrame([(k, *c[:4]) for k, c in enumerate(checks)], "check int, severity string, code string, stage string, feature string")
    counts = violations(df, checks).groupBy("check").agg(F.count(F.lit(1)).alias("count"))
    out = counts.join(F.broadcast(listed), "check")  # a row for each check
    if not examples:
        return out.select("severity", "code", "stage", "feature", "count")
    first = Window.partitionBy("check").orderBy("source_file", "row_number")
    some = violations(df, checks, True).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= examples)
    text = F.concat_ws(":", "source_file", "row_number", F.coalesce("value", F.lit("null")))
    some = some.groupBy("check").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", text.alias("t")))), lambda x: x["t"]).alias("examples"))
    return out.join(some, "check", "left").select("severity", "code", "stage", "feature", "count", "examples")


def row_checks(dataset_id: str, config_name: str, required_columns: list[str]) -> list[tuple]:
    """Identity, split, label, dataset and required-null conditions on a samples table."""
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    checks = [("error", "REQUIRED_NULL", "source", c, F.col(c).isNull()) for c in required_columns]
    checks += [
        ("error", "IDENTITY", "identity", "hash", bad(F.lower("hash").rlike("^[0-9a-f]{64}$"))),
        ("error", "SPLIT_INVALID", "split", "split_name", bad(F.col("split_name").isin("train", "test")) | bad(F.col("year_month").rlike(MONTH))),
        ("error", "LABEL_DOMAIN", "label", "label", bad(F.col("label").isin(0, 1))),
        ("error", "DATASET_MISMATCH", "source", "dataset_id", bad(F.col("dataset_id") == dataset_id) | bad(F.col("config_name") == config_name)),
    ]
    return checks


def _domain_checks(n: Node) -> list[tuple]:
    x, e = F.col(n.name), "error"
    num = S.number(x)
    non_finite = F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    finite = F.coalesce(~non_finite, F.lit(False))
    out = [(e, "NON_FINITE", "value", n.id, non_finite)]
    low, high = n.low, n.high
    if n.kind == "binary":
        out.append((e, "BINARY_DOMAIN", "value", n.id, finite & ~num.isin(0.0, 1.0)))
        low, high = (None if low in (None, 0) else low), (None if high in (None, 1) else high)
    if low is not None:
        out.append((e, "RANGE_MIN", "value", n.id, finite & (num < low)))
    if high is not None:
        out.append((e, "RANGE_MAX", "value", n.id, finite & (num > high)))
    if n.allowed:
        out.append((e, "CATEGORY_DOMAIN", "value", n.id, x.isNotNull() & ~x.isin(*n.allowed)))
    return out


def plan_checks(plan: FeaturePlan) -> list[tuple]:
    """Conditions on ``plan.apply(..., checks=True)``: type, null policy, domain and transform of every node."""
    out = []
    for n in plan.order:
        f = lambda x, n=n: F.col(f"{n.name}__{x}")
        out.append(("error", "TYPE_OVERFLOW", "type", n.id, f("overflow")))
        out.append(("error", "TRANSFORM_FAILED", "transform", n.id, f("failed")))
        if n.missing == "error":
            out.append(("error", "UNHANDLED_NULL" if n.input is None else "NULL_POLICY", "null", n.id, f("null")))
        out += _domain_checks(n)
    return out


def model_checks(plan: FeaturePlan, unit_interval: bool = False) -> list[tuple]:
    """Conditions on outputs as model input: finite as float, whole numbers exact as float, in [0, 1] where asked."""
    out = []
    for ref in plan.outputs:
        n = plan.node(ref)
        x = F.col(n.name)
        single = x.cast("double").cast("float").cast("double")
        lost = (single != x.cast("double")) if n.type in S.INT_TYPES else F.lit(False)
        out.append(("error", "TENSOR_NON_FINITE", "tensor", n.id, F.isnan(single) | (F.abs(single) == float("inf"))))
        out.append(("error", "TENSOR_PRECISION", "tensor", n.id, lost))
        if unit_interval:
            out.append(("error", "MODEL_DOMAIN", "tensor", n.id, (single < 0) | (single > 1)))
    return out


def _issues(df: DataFrame, severity: str, code: str | Column, stage: str, feature: str | Column, count: Column) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(F.lit(severity).alias("severity"), lit(code).alias("code"), F.lit(stage).alias("stage"), lit(feature).alias("feature"), count.cast("long").alias("count"))


def split_classes(df: DataFrame, splits: tuple[str, ...] = SPLITS, split: str = "split_name", label: str = "label") -> DataFrame:
    """SPLIT_CLASSES for each of ``splits`` that lacks rows of a class (an absent split lacks both), and EMPTY_DATASET for no rows."""
    return _split_classes(df.groupBy(F.col(split).cast("string").alias("split"), F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n")), splits)


def _split_classes(classes: DataFrame, splits: tuple[str, ...]) -> DataFrame:
    """The same from (split, label, n)."""
    y = F.col("label").try_cast("double")
    n = classes.groupBy("split").agg(((F.count_if(y == 0) > 0) & (F.count_if(y == 1) > 0)).alias("both_classes"))
    wanted = classes.sparkSession.createDataFrame([(s,) for s in splits], "split string")
    short = wanted.join(n, "split", "left").filter(~F.coalesce("both_classes", F.lit(False)))
    empty = classes.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    none = _issues(empty, "error", "EMPTY_DATASET", "source", F.lit(None).cast("string"), F.lit(1))
    return none.unionByName(_issues(short, "error", "SPLIT_CLASSES", "split", F.col("split"), F.lit(1)))


def outlier_issues(moments: DataFrame, sigmas: float = 8.0) -> DataFrame:
    """STATISTICAL_OUTLIER warnings of columns that are not binary and whose maximum lies far beyond the mean; no rule is inferred from them."""
    deviation = F.sqrt(F.col("m2") / F.nullif(F.col("finite"), F.lit(0)))
    far = (deviation > 0) & (F.col("not_binary") > F.col("non_finite")) & (F.col("high") > F.col("mean") + sigmas * deviation)
    return _issues(moments.filter(far), "warning", "STATISTICAL_OUTLIER", "profile", F.col("column_name"), F.lit(1))


def _family(kind: str) -> str:
    return "integer" if kind in S.INT_TYPES else "float" if kind in S.FLOAT_TYPES else kind


def mismatched(plan: FeaturePlan, kinds: dict[str, str]) -> list[str]:
    """Raw features declared as whole numbers over a column that holds none, or as floats over a column that is none."""
    return [n.id for n in plan.order if n.column in kinds and n.type in NUMBERS and _family(n.type) != _family(kinds[n.column])]


def without(plan: FeaturePlan, refs: list[str]) -> FeaturePlan:
    """The plan less these features and those that read them."""
    gone = set(refs)
    for n in plan.order:
        if n.input in gone:
            gone.add(n.id)
    return FeaturePlan(tuple(n for n in plan.order if n.id not in gone), tuple(o for o in plan.outputs if o not in gone))


def _to_spark(df: DataFrame, plan: FeaturePlan, unit_interval: bool) -> tuple[DataFrame, list[tuple]]:
    """``df`` with the nodes that have no array form, and the conditions on these."""
    arrays = {n.id for n in on_arrays(plan, dict(df.dtypes))}
    left = {n.id for n in plan.order if n.id not in arrays}
    if not left:
        return df, []
    needed = set(left)
    for n in reversed(plan.order):
        if n.id in needed and n.input is not None:
            needed.add(n.input)
    part = FeaturePlan(tuple(n for n in plan.order if n.id in needed), tuple(o for o in plan.outputs if o in left))
    return part.apply(df, df.columns, checks=True), [c for c in plan_checks(part) + model_checks(part, unit_interval) if c[3] in left]


def contract_audit(
    df: DataFrame, plan: FeaturePlan, dataset_id: str, config_name: str, metadata: dict[str, str], complete: bool = True, unit_interval: bool = False, splits: tuple[str, ...] = SPLITS, examples: int = 0
) -> DataFrame:
    """All diagnostics of a samples table under a plan, one row per code and feature with its count.

    A missing column is reported and nothing that needs it is run. A feature whose
    column is of another kind of number than declared is a TYPE_MISMATCH of all rows,
    and neither it nor what reads it is run. One scan over record batches gives all
    conditions on rows and features, the rows of each class and the moments of each
    column, for thousands of features as for a few (see plans.arrays); repeated
    identities are found in a second one that reads no features. With ``examples``,
    a column of the first so many places of each condition.
    """
    found = schema_issues(df, plan.required(), metadata)
    more = (lambda x: x.withColumn("examples", F.lit(None).cast("array<string>"))) if examples else (lambda x: x)
    found = more(found)
    if not any(c not in df.columns for c in [*plan.required(), *metadata]):
        kinds = dict(df.dtypes)
        wrong = mismatched(plan, kinds)
        sound = without(plan, wrong)
        checked, conditions = _to_spark(df, sound, unit_interval)
        numbers = [c for c in plan.required() if kinds[c] in NUMBERS]
        state, listed = scan(checked, sound, row_checks(dataset_id, config_name, []) + conditions, unit_interval, examples, numbers, ("split_name", "label"))
        found = found.unionByName(check_counts(state, listed, examples))
        classes = class_rows(state)
        if wrong:
            rows = classes.agg(F.sum("n").alias("count")).filter("count > 0")
            each = rows.select(F.explode(F.array(*[F.lit(w) for w in wrong])).alias("feature"), "count")
            found = found.unionByName(more(_issues(each, "error", "TYPE_MISMATCH", "type", F.col("feature"), F.col("count"))))
        same = identity_issues(df).groupBy("code").agg(F.count(F.lit(1)).alias("count"))
        found = found.unionByName(more(_issues(same, "error", F.col("code"), "identity", "hash", F.col("count"))))
        found = found.unionByName(more(_split_classes(classes, splits))).unionByName(more(outlier_issues(moments_of(state, numbers))))
    if not complete:
        found = found.unionByName(more(_rows(df.sparkSession, [("warning", "SAMPLED_AUDIT", "scan", None, 1)])))
    return found


def audit_declared(df: DataFrame, nodes: list[Node], outputs: list[str], *args, **options) -> DataFrame:
    """contract_audit of a graph that is not compiled yet; one that cannot be is a CONTRACT_INVALID error with the reason as its feature, and schema and rows are audited all the same."""
    examples = options.get("examples", 0)
    try:
        return contract_audit(df, FeaturePlan.compile(nodes, outputs), *args, **options)
    except ValueError as e:
        found = contract_audit(df, FeaturePlan((), ()), *args, **options)
        bad = _rows(df.sparkSession, [("error", "CONTRACT_INVALID", "contract", str(e), 1)])
        return found.unionByName(bad.withColumn("examples", F.lit(None).cast("array<string>")) if examples else bad)


def tensor_issues(staged: DataFrame, width: int) -> DataFrame:
    """TENSOR_DTYPE, TENSOR_FORMAT and TENSOR_SHAPE of staged sparse rows (indices, values), counted in one pass.

    The format is an ascending list of indices with one value, neither null nor 0, for
    each; the shape is that of ``width`` columns.
    """
    kinds = dict(staged.dtypes)
    if kinds.get("indices") != "array<int>" or kinds.get("values") != "array<float>":
        return _rows(staged.sparkSession, [("error", "TENSOR_DTYPE", "tensor", c, 1) for c, t in (("indices", "array<int>"), ("values", "array<float>")) if kinds.get(c) != t])
    i, v = F.col("indices"), F.col("values")
    ordered = F.size(F.filter(i, lambda x, k: (k > 0) & (x <= F.get(i, k - 1)))) == 0
    sound = (F.size(i) == F.size(v)) & ordered & ~F.exists(v, lambda x: x.isNull() | (x == 0)) & ~F.exists(i, lambda x: x.isNull())
    outside = F.exists(i, lambda x: (x < 0) | (x >= width))
    n = staged.agg(F.count_if(~F.coalesce(sound, F.lit(False))).alias("TENSOR_FORMAT"), F.count_if(F.coalesce(outside, F.lit(False))).alias("TENSOR_SHAPE"))
    cells = [F.struct(F.lit("error").alias("severity"), F.lit(c).alias("code"), F.lit("tensor").alias("stage"), F.lit(None).cast("string").alias("feature"), F.col(c).alias("count")) for c in n.columns]
    return n.select(F.explode(F.array(*cells)).alias("x")).select("x.*").filter("count > 0")


def run_audit(spark: SparkSession, audit: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """(issues, whether the scan came to its end): runs an audit and stores its issues.

    A scan that fails leaves a report of one SCAN_FAILED error with the kind of the
    failure as its feature, never its text; it is not complete, so nothing is certified
    or published from it.
    """
    try:
        return write_read(audit()), True
    except (AnalysisException, ParseException):
        raise  # the caller's mistake, not the source's
    except (PySparkException, Py4JJavaError) as e:
        return _rows(spark, [("error", "SCAN_FAILED", "source", type(e).__name__, 1)]), False


def certify(issues: DataFrame, complete: bool, binding: dict[str, str]) -> DataFrame:
    """One certificate row: errors, warnings, status and certified, bound to contract, source, split policy and model."""
    n = issues.agg(F.coalesce(F.sum(F.when(F.col("severity") == "error", F.col("count"))), F.lit(0)).alias("errors"), F.coalesce(F.sum(F.when(F.col("severity") == "warning", F.col("count"))), F.lit(0)).alias("warnings"))
    status = F.when(F.col("errors") > 0, "failed").when(F.lit(complete), "passed").otherwise("advisory")
    return n.withColumn("status", status).withColumn("certified", (F.col("errors") == 0) & F.lit(complete)).withColumns({k: F.lit(v) for k, v in sorted(binding.items())})


def require_certified(certificate: DataFrame, binding: dict[str, str]) -> None:
    """Refuses a certificate that is not certified or is bound to anything else."""
    row = certificate.first()
    if row is None or not row["certified"] or any(row[k] != v for k, v in binding.items()):
        raise ValueError("the audit does not certify this data")


def stage(df: DataFrame, plan: FeaturePlan, certificate: DataFrame, binding: dict[str, str], path: str, keep: list[str]) -> None:
    """Writes (keep, indices, values), sparse rows of the outputs, partitioned by split, only for a matching certificate."""
    require_certified(certificate, binding)
    sparse_features(df, plan, keep).write.mode("errorifexists").partitionBy("split").parquet(path)


def _marker(path: str, audit_id: str) -> str:
    return f"{path}/committed/{hashlib.sha256(audit_id.encode()).hexdigest()}.json"


def publish(spark: SparkSession, observations: DataFrame, path: str, audit_id: str, complete: bool) -> int:
    """Publishes field rows and one completion row of an audit; returns the rows written (0 if it is there already).

    Rows are staged in a folder of their own and count once the audit's marker, which
    only one writer can create, names that folder. An incomplete or empty scan is
    refused, and so is another payload under the same id.
    """
    if not complete or observations.isEmpty():
        raise ValueError("only complete scans with rows are published")
    fields = observations.select(F.lit(audit_id).alias("audit_id"), F.lit("field").alias("record_kind"), "column_name", F.to_json(F.struct(*[F.col(c) for c in sorted(observations.columns)])).alias("payload"))
    fields = fields.withColumn("payload_sha256", F.sha2("payload", 256))
    done = fields.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("payload_sha256"))), 256).alias("payload_sha256"), F.count(F.lit(1)).cast("string").alias("payload"))
    done = done.select(F.lit(audit_id).alias("audit_id"), F.lit("complete").alias("record_kind"), F.lit(None).cast("string").alias("column_name"), "payload", "payload_sha256")
    folder = f"{path}/rows/{uuid.uuid4().hex}"
    fields.unionByName(done).write.parquet(folder)
    staged = spark.read.parquet(folder)
    digest, n = staged.filter("record_kind = 'complete'").first()["payload_sha256"], staged.count()
    if create_once(spark, _marker(path, audit_id), json.dumps({"audit_id": audit_id, "folder": folder, "digest": digest, "n_rows": n})):
        return n
    if json.loads(read_small(spark, _marker(path, audit_id)))["digest"] != digest:
        raise ValueError("another payload is published under this audit id")
    return 0


def markers(spark: SparkSession, path: str) -> DataFrame:
    """(audit_id, folder, digest, n_rows, committed_at) of the audits that are published; no folder is an error."""
    return spark.read.schema("audit_id string, folder string, digest string, n_rows long").json(f"{path}/committed/*.json").withColumn("committed_at", F.col("_metadata.file_modification_time"))


def published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of published audits, with committed_at; what a writer left without a marker is not seen."""
    rows = spark.read.schema("audit_id string, record_kind string, column_name string, payload string, payload_sha256 string").parquet(f"{path}/rows/*")
    rows = rows.withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), r"/rows/([0-9a-f]{32})/", 1))
    known = markers(spark, path).select(F.regexp_extract("folder", r"/rows/([0-9a-f]{32})$", 1).alias("folder"), "committed_at")
    return rows.join(known, "folder").drop("folder")


def latest_observations(spark: SparkSession, path: str) -> DataFrame:
    """The newest published field row of each column."""
    return latest(published(spark, path).filter("record_kind = 'field'"), "column_name", "committed_at")


def publish_or_report(spark: SparkSession, observations: DataFrame, path: str, audit_id: str, complete: bool) -> DataFrame:
    """Issues of publishing: none, or one OBSERVATION_WRITE error with the kind of the failure as its feature, which keeps an audit from certifying."""
    try:
        publish(spark, observations, path, audit_id, complete)
    except (ValueError, PySparkException, Py4JJavaError) as e:
        return _rows(spark, [("error", "OBSERVATION_WRITE", "publication", type(e).__name__, 1)])
    return _rows(spark, [])


def latest(history: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key."""
    return history.groupBy(key).agg(F.max_by(F.struct(*history.columns), order).alias("x")).select("x.*")
