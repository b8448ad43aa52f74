"""Contract audit, certification, staging and observations over the samples view."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.operators import profile as P
from broadloom.operators.splits import split_hash
from broadloom.plans import audit as A
from broadloom.plans import feature_plan as G
from broadloom.plans.arrays import sparse_features
from broadloom.queries.features import _SPLIT, SEED
from broadloom.session import scratch
from broadloom.sources.views import FEATURES, SAMPLES_SQL, samples

METADATA = {"hash": "string", "label": "int", "split_name": "string", "year_month": "string"}
BINDING = {"contract": "presence-v1", "source": "orders", "split_policy": "hash-v1", "model": "logistic"}


def _dirty(spark, sf_dir):
    """Samples with faults by row number: identities, labels, months, splits, nulls, extremes."""
    r, big = F.col("row_number"), F.col("feat_1").cast("double")
    return samples(spark, sf_dir).withColumns(
        {
            "hash": F.when(r % 31 == 3, "abc").when(r % 37 == 4, None).otherwise(F.col("hash")),
            "label": F.when(r % 41 == 5, 2).when(r % 43 == 6, None).otherwise(F.col("label")),
            "year_month": F.when(r % 47 == 7, "2025-13").otherwise(F.col("year_month")),
            "split_name": F.when(r % 53 == 8, "validation").otherwise(F.col("split_name")),
            "dataset_id": F.when(r % 59 == 9, "other").otherwise(F.col("dataset_id")),
            "feat_0": F.when(r % 61 == 10, None).otherwise(F.col("feat_0")),
            "feat_1": F.when(r % 67 == 11, float("nan")).when(r % 71 == 12, float("inf")).when(r % 73 == 13, -2.0).otherwise(big),
            "feat_2": F.when(r % 79 == 14, (1 << 24) + 1).otherwise(F.col("feat_2")),
        }
    )


_DIRTY = f"""{SAMPLES_SQL}, dirty AS (SELECT * REPLACE (
  CASE WHEN row_number % 31 = 3 THEN 'abc' WHEN row_number % 37 = 4 THEN NULL ELSE hash END AS hash,
  CASE WHEN row_number % 41 = 5 THEN 2 WHEN row_number % 43 = 6 THEN NULL ELSE label END AS label,
  CASE WHEN row_number % 47 = 7 THEN '2025-13' ELSE year_month END AS year_month,
  CASE WHEN row_number % 53 = 8 THEN 'validation' ELSE split_name END AS split_name,
  CASE WHEN row_number % 59 = 9 THEN 'other' ELSE dataset_id END AS dataset_id,
  CASE WHEN row_number % 61 = 10 THEN NULL ELSE feat_0 END AS feat_0,
  CASE WHEN row_number % 67 = 11 THEN 'nan'::DOUBLE WHEN row_number % 71 = 12 THEN 'infinity'::DOUBLE WHEN row_number % 73 = 13 THEN -2 ELSE CAST(feat_1 AS DOUBLE) END AS feat_1,
  CASE WHEN row_number % 79 = 14 THEN 16777217 ELSE feat_2 END AS feat_2) FROM samples)"""


def _plan():
    nodes = [
        G.Node("f0@1", column="feat_0", source="orders", type="bigint", kind="binary", missing="error"),
        G.Node("f1@1", column="feat_1", source="orders", type="double", low=0.0, high=4.0),
        G.Node("f1.log@1", input="f1@1", op="log1p_nonnegative", type="double", missing="error"),
        G.Node("f2@1", column="feat_2", source="orders", type="int", kind="categorical", allowed=(0, 1, 2, 3)),
    ]
    return G.FeaturePlan.compile(nodes, ["f0@1", "f1.log@1", "f2@1"])


def _counts(spark, sf_dir, checks):
    return A.count_checks(_plan().apply(_dirty(spark, sf_dir), ["hash"], checks=True), checks).select("code", "feature", "count")


def _some(*codes):
    return lambda spark, sf_dir: _counts(spark, sf_dir, [c for c in A.plan_checks(_plan()) + A.model_checks(_plan(), True) if c[1] in codes])


def audit_schema(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return A.schema_issues(rows.withColumn("label", F.col("label").cast("string")), ["feat_0", "feat_9"], METADATA).crossJoin(F.broadcast(rows.agg(F.count("*").alias("n_rows"))))  # one row


def audit_required_null(spark, sf_dir):
    return A.count_checks(_dirty(spark, sf_dir), A.row_checks("orders", "wide", ["hash", "feat_0", "label"])[:3]).select("code", "feature", "count")


def _row(code):
    return lambda spark, sf_dir: A.count_checks(_dirty(spark, sf_dir), [c for c in A.row_checks("orders", "wide", []) if c[1] == code]).select("code", "feature", "count")


def audit_identity(spark, sf_dir):
    rows = _dirty(spark, sf_dir)
    same = P.identity_issues(rows).groupBy("code").agg(F.count("*").alias("count"))
    return _row("IDENTITY")(spark, sf_dir).select("code", "count").unionByName(same)


def contract_audit(spark, sf_dir):
    found = A.contract_audit(_dirty(spark, sf_dir), _plan(), "orders", "wide", METADATA, complete=True, unit_interval=True)
    return found.select("severity", "code", "feature", "count")


def audit_type(spark, sf_dir):
    """Features declared as another kind of number than their column holds, and values that their type cannot hold."""
    nodes = [G.Node("t0@1", column="feat_0", source="orders", type="bigint"), G.Node("t1@1", column="feat_1", source="orders", type="bigint"), G.Node("t2@1", column="feat_2", source="orders", type="smallint")]
    nodes += [G.Node("t0.float@1", column="feat_0", source="orders", type="double"), G.Node("t1.has@1", input="t1@1", op="positive_presence", type="float")]
    found = A.audit_declared(_dirty(spark, sf_dir), nodes, [n.id for n in nodes], "orders", "wide", METADATA)
    return found.filter("stage = 'type'").select("code", "feature", "count")


def _sparse(spark, sf_dir):
    nodes = [n for c in FEATURES for n in (G.Node(f"{c}.raw@1", column=c, source="orders", type="bigint"), G.Node(f"{c}@1", input=f"{c}.raw@1", type="float", missing="error"))]
    return sparse_features(samples(spark, sf_dir), G.FeaturePlan.compile(nodes, [f"{c}@1" for c in FEATURES]), ["hash", "row_number"])


def assemble_sparse(spark, sf_dir):
    """The features of each sample as a sparse row."""
    return _sparse(spark, sf_dir).select("hash", F.array_join("indices", ",").alias("indices"), F.array_join(F.transform("values", lambda x: x.cast("long")), ",").alias("values"))


def audit_tensor(spark, sf_dir):
    """Sparse rows with indices out of order or outside the width, by row number."""
    r, i = F.col("row_number"), F.col("indices")
    faulty = F.when(r % 97 == 3, F.reverse(i)).when(r % 101 == 4, F.transform(i, lambda x: x + 10)).otherwise(i)
    return A.tensor_issues(_sparse(spark, sf_dir).withColumn("indices", faulty), len(FEATURES)).select("code", "count")


def audit_coverage(spark, sf_dir):
    """Audits that cannot certify: of a sample of the rows, of no rows, and of a scan that fails; with the rows each has read."""
    rows = samples(spark, sf_dir)
    part = rows.filter(F.pmod(F.col("row_number"), F.lit(10)) == 0)
    broken = rows.withColumn("feat_0", F.when(F.col("row_number") == 7, F.raise_error(F.lit("a signed address")).cast("bigint")).otherwise(F.col("feat_0")))
    out = None
    for name, df, complete in (("sample", part, False), ("none", rows.filter("hash = ''"), True), ("broken", broken, True)):
        issues, done = A.run_audit(spark, lambda df=df, complete=complete: A.contract_audit(df, _clean_plan(), "orders", "wide", METADATA, complete=complete))
        one = issues.filter("code IN ('SAMPLED_AUDIT', 'EMPTY_DATASET', 'SCAN_FAILED')").select(F.lit(name).alias("audit"), "severity", "code", "count", F.lit(done).alias("done"))
        certified = A.certify(issues, complete and done, BINDING).select("certified")
        one = one.crossJoin(F.broadcast(certified))  # one row
        read = (df if done else df.limit(0)).agg(F.count("*").alias("n_rows"))
        one = one.crossJoin(F.broadcast(read))  # one row
        out = one if out is None else out.unionByName(one)
    return out


def audit_examples(spark, sf_dir):
    """The first three places of each violation of the contract, beside its count."""
    found = A.contract_audit(_dirty(spark, sf_dir), _plan(), "orders", "wide", METADATA, examples=3).filter("code IN ('BINARY_DOMAIN', 'CATEGORY_DOMAIN', 'LABEL_DOMAIN')")
    return found.select("code", "feature", "count", F.array_join("examples", ",").alias("examples"))


def audit_split(spark, sf_dir):
    """Invalid splits and months, and a test split with one class only."""
    rows = _dirty(spark, sf_dir)
    invalid = A.count_checks(rows, [c for c in A.row_checks("orders", "wide", []) if c[1] == "SPLIT_INVALID"])
    one_class = rows.filter("split_name <> 'test' OR label = 1")
    return invalid.unionByName(A.split_classes(one_class, ("train", "test", "validation"))).select("code", "feature", "count")


def audit_outliers(spark, sf_dir):
    """Warnings of an audit whose counts hold a spike, which certifies all the same."""
    rows = _wide(spark, sf_dir).withColumn("feat_0", F.when(F.col("row_number") % 997 == 5, 100_000).otherwise(F.col("feat_0")))
    issues, done = A.run_audit(spark, lambda: A.contract_audit(rows, _clean_plan(), "orders", "wide", METADATA))
    certified = A.certify(issues, done, BINDING).select("status", "certified")
    return issues.select("severity", "code", "feature", "count").crossJoin(F.broadcast(certified))  # one row


def _clean_plan():
    return G.FeaturePlan.compile(G.presence_nodes(FEATURES, "orders"), [f"{c}.presence@1" for c in FEATURES])


def _wide(spark, sf_dir):
    return samples(spark, sf_dir).filter("config_name = 'wide'")


def certify(spark, sf_dir):
    """Certificates of the presence contract and of the strict one."""
    out = None
    for plan in (_clean_plan(), _plan()):
        issues = A.contract_audit(_wide(spark, sf_dir), plan, "orders", "wide", METADATA)
        one = A.certify(issues, True, BINDING | {"contract": plan.outputs[0]}).select("contract", "status", "certified", F.col("errors") > 0)
        one = one.toDF("contract", "status", "certified", "has_errors")
        out = one if out is None else out.unionByName(one)
    return out


def stage_features(spark, sf_dir):
    rows, path = _wide(spark, sf_dir).withColumn("split", split_hash(F.col("split_name"), F.col("hash"), SEED)), scratch(spark)
    certificate = A.certify(A.contract_audit(rows, _clean_plan(), "orders", "wide", METADATA), True, BINDING)
    A.stage(rows, _clean_plan(), certificate, BINDING, path, ["hash", "label", "year_month", "split"])
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count("*").alias("n_rows"), F.sum(F.aggregate("values", F.lit(0.0).cast("float"), lambda a, x: a + x)).cast("long").alias("present"))


def _observed(spark, sf_dir):
    return P.profile(P.value_counts(samples(spark, sf_dir), ["label", *FEATURES]))


def publish_observations(spark, sf_dir):
    path = scratch(spark)
    for audit_id in ("a1", "a1", "a2"):
        A.publish(spark, _observed(spark, sf_dir), path, audit_id, True)
    return A.published(spark, path).groupBy("audit_id", "record_kind").agg(F.count("*").alias("n"))


def audit_publication(spark, sf_dir):
    """Publishing one audit twice, another payload under its id, and an incomplete scan: what each reports, and the newest row count of each column."""
    path, rows = scratch(spark), _observed(spark, sf_dir)
    more = _observed(spark, sf_dir).withColumn("row_count", F.col("row_count") + 1)
    out = None
    for k, (audit_id, observed, complete) in enumerate([("a1", rows, True), ("a1", rows, True), ("a1", more, True), ("a2", more, True), ("a3", rows, False)]):
        found = A.publish_or_report(spark, observed, path, audit_id, complete).select(F.lit(k).alias("attempt"), "code", F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("long").alias("row_count"))
        out = found if out is None else out.unionByName(found)
    newest = A.latest_observations(spark, path).select(F.lit(None).cast("int").alias("attempt"), F.col("audit_id").alias("code"), "column_name", F.get_json_object("payload", "$.row_count").cast("long").alias("row_count"))
    return out.unionByName(newest)


def observation_history(spark, sf_dir):
    p = _observed(spark, sf_dir).select("column_name", "row_count")
    history = p.withColumn("at", F.lit(1)).unionByName(p.withColumns({"at": F.lit(2), "row_count": F.col("row_count") + 1}))
    return A.latest(history, "column_name", "at")


def observation_gate(spark, sf_dir):
    rows = []
    for complete in (True, False):
        try:
            n = A.publish(spark, _observed(spark, sf_dir), scratch(spark), "x", complete)
        except ValueError:
            n = 0
        rows.append((complete, n))
    return spark.createDataFrame(rows, "complete boolean, published long")


QUERIES = {f.__name__: f for f in [audit_schema, audit_type, assemble_sparse, audit_tensor, audit_required_null, audit_identity, contract_audit, audit_coverage, audit_examples, audit_split, audit_outliers, certify, stage_features, publish_observations, audit_publication, observation_history, observation_gate]} | {
    "audit_label": _row("LABEL_DOMAIN"), "audit_dataset": _row("DATASET_MISMATCH"), "audit_null": _some("UNHANDLED_NULL", "NULL_POLICY"),
    "audit_finite": _some("NON_FINITE"), "audit_domain": _some("BINARY_DOMAIN", "RANGE_MIN", "RANGE_MAX", "CATEGORY_DOMAIN"), "audit_transform": _some("TRANSFORM_FAILED"),
    "audit_model_input": _some("TENSOR_NON_FINITE", "TENSOR_PRECISION", "MODEL_DOMAIN"),
}

_fin = "(NOT isnan({0}) AND NOT isinf({0}))"
_LOG1P = "CASE WHEN feat_1 >= 0 OR isnan(feat_1) THEN CASE WHEN isnan(feat_1) THEN 'nan'::DOUBLE WHEN isinf(feat_1) THEN 'infinity'::DOUBLE ELSE ln(1 + feat_1) END END"
_CONDS = {
    ("REQUIRED_NULL", "hash"): "hash IS NULL", ("REQUIRED_NULL", "feat_0"): "feat_0 IS NULL", ("REQUIRED_NULL", "label"): "label IS NULL",
    ("IDENTITY", "hash"): "NOT coalesce(regexp_matches(lower(hash), '^[0-9a-f]{64}$'), false)",
    ("SPLIT_INVALID", "split_name"): "NOT (split_name IN ('train', 'test') AND regexp_matches(year_month, '^\\d{4}-(0[1-9]|1[0-2])$'))",
    ("LABEL_DOMAIN", "label"): "NOT coalesce(label IN (0, 1), false)",
    ("DATASET_MISMATCH", "dataset_id"): "NOT (dataset_id = 'orders' AND config_name = 'wide')",
    ("UNHANDLED_NULL", "f0@1"): "feat_0 IS NULL",
    ("NON_FINITE", "f1@1"): f"NOT {_fin.format('feat_1')}", ("NON_FINITE", "f1.log@1"): "isnan(feat_1) OR feat_1 = 'infinity'::DOUBLE",
    ("BINARY_DOMAIN", "f0@1"): "feat_0 NOT IN (0, 1)", ("RANGE_MIN", "f1@1"): f"{_fin.format('feat_1')} AND feat_1 < 0", ("RANGE_MAX", "f1@1"): f"{_fin.format('feat_1')} AND feat_1 > 4",
    ("CATEGORY_DOMAIN", "f2@1"): "feat_2 NOT IN (0, 1, 2, 3)", ("TRANSFORM_FAILED", "f1.log@1"): "NOT isnan(feat_1) AND feat_1 < 0",
    ("TENSOR_NON_FINITE", "f1.log@1"): "isnan(feat_1) OR feat_1 = 'infinity'::DOUBLE", ("TENSOR_PRECISION", "f2@1"): "feat_2 = 16777217",
    ("MODEL_DOMAIN", "f0@1"): "feat_0 < 0 OR feat_0 > 1", ("MODEL_DOMAIN", "f1.log@1"): f"({_LOG1P}) > 1", ("MODEL_DOMAIN", "f2@1"): "feat_2 < 0 OR feat_2 > 1",
}


def _sql(*codes: str) -> str:
    parts = [f"SELECT '{c}' AS code, '{f}' AS feature, count(*) FILTER ({cond}) AS count FROM dirty" for (c, f), cond in _CONDS.items() if c in codes]
    return f"WITH {_DIRTY}, found AS ({' UNION ALL '.join(parts)}) SELECT * FROM found WHERE count > 0"


_SAME = """ident AS (SELECT lower(hash) AS i, split_name, row_number() OVER (PARTITION BY lower(hash) ORDER BY source_file, row_number) AS k, first_value(split_name) OVER (PARTITION BY lower(hash) ORDER BY source_file, row_number) AS f FROM dirty WHERE hash IS NOT NULL),
same AS (SELECT CASE WHEN split_name = f THEN 'DUPLICATE' ELSE 'SPLIT_OVERLAP' END AS code, count(*) AS count FROM ident WHERE k > 1 GROUP BY 1)"""
_ALL = ("IDENTITY", "SPLIT_INVALID", "LABEL_DOMAIN", "DATASET_MISMATCH", "UNHANDLED_NULL", "NULL_POLICY", "NON_FINITE", "BINARY_DOMAIN", "RANGE_MIN", "RANGE_MAX", "CATEGORY_DOMAIN", "TRANSFORM_FAILED", "TENSOR_NON_FINITE", "TENSOR_PRECISION", "MODEL_DOMAIN")

_OUT = "stddev_pop({0}) > 0 AND max({0}) > avg({0}) + 8 * stddev_pop({0}) AND NOT bool_and({0} IN (0, 1))"
_WARNED = "".join(f" UNION ALL SELECT 'warning', 'STATISTICAL_OUTLIER', '{c}', 1 FROM (SELECT CAST({c} AS DOUBLE) AS x FROM dirty WHERE {_fin.format(f'CAST({c} AS DOUBLE)')}) HAVING {_OUT.format('x')}" for c in FEATURES)

SQL = {
    "audit_required_null": _sql("REQUIRED_NULL"), "audit_label": _sql("LABEL_DOMAIN"), "audit_dataset": _sql("DATASET_MISMATCH"),
    "audit_null": _sql("UNHANDLED_NULL", "NULL_POLICY"), "audit_finite": _sql("NON_FINITE"), "audit_domain": _sql("BINARY_DOMAIN", "RANGE_MIN", "RANGE_MAX", "CATEGORY_DOMAIN"), "audit_transform": _sql("TRANSFORM_FAILED"),
    "audit_model_input": _sql("TENSOR_NON_FINITE", "TENSOR_PRECISION", "MODEL_DOMAIN"),
    "audit_type": f"""WITH {_DIRTY} SELECT 'TYPE_OVERFLOW' AS code, 't2@1' AS feature, count(*) AS count FROM dirty WHERE feat_2 > 32767 HAVING count(*) > 0
 UNION ALL SELECT 'TYPE_MISMATCH', f, count(*) FROM dirty, (VALUES ('t1@1'), ('t0.float@1')) AS t(f) GROUP BY f""",
    "assemble_sparse": f"""WITH {SAMPLES_SQL}, x AS (SELECT hash, list_filter([struct_pack(i := 0, v := feat_0), struct_pack(i := 1, v := feat_1), struct_pack(i := 2, v := feat_2)], lambda c: c.v <> 0) AS c FROM samples)
 SELECT hash, array_to_string(list_transform(c, lambda e: e.i), ',') AS indices, array_to_string(list_transform(c, lambda e: e.v), ',') AS values FROM x""",
    "audit_tensor": f"""WITH {SAMPLES_SQL}, x AS (SELECT row_number, CAST(feat_0 <> 0 AS INT) + CAST(feat_1 <> 0 AS INT) + CAST(feat_2 <> 0 AS INT) AS n FROM samples)
 SELECT 'TENSOR_FORMAT' AS code, count(*) AS count FROM x WHERE row_number % 97 = 3 AND n > 1 HAVING count(*) > 0
 UNION ALL SELECT 'TENSOR_SHAPE', count(*) FROM x WHERE row_number % 101 = 4 AND row_number % 97 <> 3 AND n > 0 HAVING count(*) > 0""",
    "audit_identity": _sql("IDENTITY").replace("SELECT * FROM found", f", {_SAME} SELECT code, count FROM found", 1).replace(") , ", "), ") + " UNION ALL SELECT code, count FROM same",
    "contract_audit": _sql(*_ALL).replace("SELECT * FROM found", f", {_SAME} SELECT 'error' AS severity, code, feature, count FROM found", 1).replace(") , ", "), ") + " UNION ALL SELECT 'error', code, 'hash', count FROM same" + _WARNED,
    "audit_coverage": f"""WITH {SAMPLES_SQL} SELECT 'sample' AS audit, 'warning' AS severity, 'SAMPLED_AUDIT' AS code, CAST(1 AS BIGINT) AS count, true AS done, false AS certified, count(*) FILTER (row_number % 10 = 0) AS n_rows FROM samples
 UNION ALL SELECT 'none', 'error', 'EMPTY_DATASET', 1, true, false, count(*) FILTER (hash = '') FROM samples UNION ALL SELECT 'broken', 'error', 'SCAN_FAILED', 1, false, false, 0 WHERE EXISTS (SELECT 1 FROM samples WHERE row_number = 7)""",
    "audit_examples": f"""WITH {_DIRTY}, v AS (SELECT 'BINARY_DOMAIN' AS code, 'f0@1' AS feature, source_file, row_number, CAST(feat_0 AS VARCHAR) AS x FROM dirty WHERE feat_0 NOT IN (0, 1)
 UNION ALL SELECT 'CATEGORY_DOMAIN', 'f2@1', source_file, row_number, CAST(feat_2 AS VARCHAR) FROM dirty WHERE feat_2 NOT IN (0, 1, 2, 3) UNION ALL SELECT 'LABEL_DOMAIN', 'label', source_file, row_number, CAST(label AS VARCHAR) FROM dirty WHERE NOT coalesce(label IN (0, 1), false)),
r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY source_file, row_number) AS k FROM v)
SELECT code, feature, count(*) AS count, string_agg(source_file || ':' || row_number || ':' || coalesce(x, 'null'), ',' ORDER BY k) FILTER (k <= 3) AS examples FROM r GROUP BY 1, 2""",
    "audit_split": _sql("SPLIT_INVALID") + """ UNION ALL SELECT 'SPLIT_CLASSES', s, 1 FROM (VALUES ('train'), ('test'), ('validation')) AS w(s)
 WHERE NOT EXISTS (SELECT 1 FROM dirty WHERE split_name = s AND label = 0 AND split_name <> 'test') OR NOT EXISTS (SELECT 1 FROM dirty WHERE split_name = s AND label = 1)""",
    "audit_outliers": f"WITH {SAMPLES_SQL}, w AS (SELECT * REPLACE (CASE WHEN row_number % 997 = 5 THEN 100000 ELSE feat_0 END AS feat_0) FROM samples WHERE config_name = 'wide') "
    + " UNION ALL ".join(f"SELECT 'warning' AS severity, 'STATISTICAL_OUTLIER' AS code, '{c}' AS feature, CAST(1 AS BIGINT) AS count, 'passed' AS status, true AS certified FROM w HAVING {_OUT.format(c)}" for c in FEATURES),
    "certify": "SELECT * FROM (VALUES ('feat_0.presence@1', 'passed', true, false), ('f0@1', 'failed', false, true)) AS t(contract, status, certified, has_errors) WHERE EXISTS (SELECT 1 FROM orders)",
    "stage_features": f"WITH {SAMPLES_SQL} SELECT {_SPLIT} AS split, label, count(*) AS n_rows, CAST(sum(CAST(feat_0 > 0 AS INTEGER) + CAST(feat_1 > 0 AS INTEGER) + CAST(feat_2 > 0 AS INTEGER)) AS BIGINT) AS present FROM samples WHERE config_name = 'wide' GROUP BY 1, 2",
    "publish_observations": "SELECT audit_id, record_kind, n FROM (VALUES ('a1', 'field', CAST(4 AS BIGINT)), ('a1', 'complete', 1), ('a2', 'field', 4), ('a2', 'complete', 1)) AS t(audit_id, record_kind, n) WHERE EXISTS (SELECT 1 FROM orders)",
    "audit_publication": """SELECT attempt, code, NULL AS column_name, CAST(NULL AS BIGINT) AS row_count FROM (VALUES (2, 'OBSERVATION_WRITE'), (4, 'OBSERVATION_WRITE')) AS t(attempt, code) WHERE EXISTS (SELECT 1 FROM orders)
 UNION ALL SELECT NULL, 'a2', unnest(['label', 'feat_0', 'feat_1', 'feat_2']), count(*) + 1 FROM orders""",
    "observation_history": "SELECT unnest(['label', 'feat_0', 'feat_1', 'feat_2']) AS column_name, count(*) + 1 AS row_count, CAST(2 AS INTEGER) AS at FROM orders",
    "audit_schema": "SELECT severity, code, stage, feature, CAST(1 AS BIGINT) AS count, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES ('error', 'MISSING_COLUMN', 'schema', 'feat_9'), ('error', 'METADATA_TYPE', 'schema', 'label')) AS t(severity, code, stage, feature)",
    "observation_gate": "SELECT complete, published FROM (VALUES (true, CAST(5 AS BIGINT)), (false, 0)) AS t(complete, published) WHERE EXISTS (SELECT 1 FROM orders)",
}
