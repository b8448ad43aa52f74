"""Joins, aggregations, profiles and identity windows over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.operators import profile as P
from broadloom.operators.splits import class_weights as weights
from broadloom.session import table
from broadloom.sources.views import FEATURES, SAMPLES_SQL, samples

_R = 6


def stg_samples(spark, sf_dir):
    samples(spark, sf_dir).createOrReplaceTempView("stg_samples")
    return spark.sql("SELECT * FROM stg_samples")


def label_summary(spark, sf_dir):
    return samples(spark, sf_dir).groupBy("config_name", "split_name", "label", "family").agg(F.count("*").alias("sample_count"), F.round(F.avg("vt_count"), _R).alias("average_vt_count"))


def not_null_tests(spark, sf_dir):
    return P.not_null_counts(samples(spark, sf_dir), ["dataset_id", "config_name", "split_name", "hash", "label", "year_month"])


def partition_counts(spark, sf_dir):
    return samples(spark, sf_dir).groupBy("config_name", "split_name").agg(F.count("*").alias("n_rows")).orderBy("config_name", "split_name")


def table_stats(spark, sf_dir):
    """Rows of each table, and stored bytes from the listing."""
    names = ["orders", "lineitem", "events"]
    rows = None
    for n in names:
        one = table(spark, sf_dir, n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(sf_dir)
    size = files.groupBy(F.regexp_extract("path", r"([^/.]+)\.parquet", 1).alias("table_name")).agg(F.sum("length").alias("bytes"))
    return rows.join(size, "table_name", "left").withColumn("holds_bytes", F.col("bytes") > 0).drop("bytes")


_PROFILED = {"customer": ["c_acctbal", "c_nationkey", "c_mktsegment"], "lineitem": ["l_quantity", "l_tax", "l_linenumber", "l_returnflag"]}


def _counts(spark, sf_dir, name="lineitem"):
    return P.value_counts(table(spark, sf_dir, name), _PROFILED[name])


def column_profile(spark, sf_dir):
    p = P.profile(_counts(spark, sf_dir, "customer")).unionByName(P.profile(_counts(spark, sf_dir, "lineitem")))
    return p.withColumns({c: F.round(c, 4) for c in ("min_value", "max_value", "mean_value", "stddev_value")}).drop("observed_domain", "distinct_count")


def distinct_exact(spark, sf_dir):
    return P.profile(_counts(spark, sf_dir, "customer")).unionByName(P.profile(_counts(spark, sf_dir, "lineitem"))).select("column_name", "distinct_count")


def observed_domain(spark, sf_dir):
    df = samples(spark, sf_dir).withColumns({"gone": F.lit(None).cast("int"), "signed": F.col("feat_0") - 1, "half": F.col("feat_0") / 2, "nan": F.lit(float("nan"))})
    return P.profile(P.value_counts(df, ["label", "feat_0", "family", "gone", "signed", "half", "nan"])).select("column_name", "observed_domain")


def top_values(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_suppkey"))
    return P.top_values(P.value_counts(rows, rows.columns))


def outlier_warning(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 997 == 5, 1000).otherwise(F.col("event_id") % 3).alias("spiked"), (F.col("event_id") % 2).alias("bit"))
    return P.outliers(P.profile(P.value_counts(df, ["spiked", "bit"]))).select("column_name", "max_value")


def split_class_counts(spark, sf_dir):
    return P.class_counts(samples(spark, sf_dir), "split_name")


def _issues(spark, sf_dir):
    rows = samples(spark, sf_dir)
    cells = [F.when(F.col(c) > 1, F.struct(F.lit("error").alias("severity"), F.lit("BINARY_DOMAIN").alias("code"), F.lit("value").alias("stage"), F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))) for c in FEATURES]
    return rows.select("source_file", "row_number", F.explode(F.array_compact(F.array(*cells))).alias("x")).select("source_file", "row_number", "x.*").withColumn("count", F.lit(1).cast("long"))


def issue_rollup(spark, sf_dir):
    return P.rollup_issues(_issues(spark, sf_dir), 3).withColumn("examples", F.array_join("examples", ","))


def bounded_examples(spark, sf_dir):
    return P.bounded_examples(_issues(spark, sf_dir), 5).select("code", "feature", "rank", "source_file", "row_number", "value")


def profile_drift(spark, sf_dir):
    """Profiles of the lines of two halves by key."""
    fields = ["row_count", "null_count", "distinct_count"]
    lines = table(spark, sf_dir, "lineitem")
    half = lambda k: P.profile(P.value_counts(lines.filter(F.col("l_orderkey") % 2 == k), ["l_quantity", "l_linenumber", "l_returnflag"]))
    return P.drift(half(1), half(0), fields)


def duplicate_apk(spark, sf_dir):
    """Orders under the identity of their customer: later orders repeat it, in the same split or in another."""
    rows = table(spark, sf_dir, "orders").select(
        F.upper(F.sha2(F.col("o_custkey").cast("string"), 256)).alias("hash"), F.lit("orders").alias("source_file"), F.col("o_orderkey").alias("row_number"), F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train").alias("split_name")
    )
    return P.identity_issues(rows)


def split_overlap(spark, sf_dir):
    return duplicate_apk(spark, sf_dir).filter("code = 'SPLIT_OVERLAP'").groupBy("split", "first_split").agg(F.count("*").alias("n"))


def row_number_per_file(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.col("_metadata.row_index").alias("row_number"))


def manifest_order(spark, sf_dir):
    return samples(spark, sf_dir).select("config_name", "source_file").distinct().orderBy("config_name", "source_file")


def top_k_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(12).select("o_orderkey", "o_totalprice")


def union_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    out = orders.filter("o_orderkey % 3 = 0")
    for k in (1, 2):
        out = out.unionByName(orders.filter(f"o_orderkey % 3 = {k}"), allowMissingColumns=False)
    return out


def category_counts(spark, sf_dir):
    """Parts per brand in the dictionary, and how many of them the second mapping holds."""
    return dictionary_join(spark, sf_dir).groupBy("category").agg(F.count("*").alias("baseline"), F.count("narrow_id").alias("narrow"))


def _dictionaries(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    token = F.concat(F.col("p_brand"), F.lit("_"), F.col("p_partkey").cast("string"))
    base = parts.select(F.concat(F.lit("feat_"), F.col("p_partkey").cast("string")).alias("column_name"), token.alias("token"), F.col("p_brand").alias("category"))
    narrow = parts.filter("p_partkey % 4 = 0").select(token.alias("token"), F.concat(F.lit("feat_"), (F.col("p_partkey") / 4).cast("long").cast("string")).alias("narrow_id"))
    return base, narrow


_DICT = """base AS (SELECT 'feat_' || CAST(p_partkey AS VARCHAR) AS column_name, p_brand || '_' || CAST(p_partkey AS VARCHAR) AS token, p_brand AS category FROM part),
narrow AS (SELECT p_brand || '_' || CAST(p_partkey AS VARCHAR) AS token, 'feat_' || CAST(p_partkey // 4 AS VARCHAR) AS narrow_id FROM part WHERE p_partkey % 4 = 0)"""


def dictionary_join(spark, sf_dir):
    base, narrow = _dictionaries(spark, sf_dir)
    return base.join(narrow, "token", "left").select("column_name", "token", "category", "narrow_id").orderBy(F.substring_index("column_name", "_", -1).cast("int"))


def dictionary_orphans(spark, sf_dir):
    base, narrow = _dictionaries(spark, sf_dir)
    return narrow.join(base.filter("category <> 'Brand#1'").filter(F.substring_index("token", "_", -1).cast("int") % 8 != 0), "token", "left_anti")


_DESCRIPTIONS = [("wide", "feat_0", "returned lines"), ("wide", "feat_1", "accepted lines"), ("narrow", "feat_0", "returned"), ("narrow", "feat_2", "open lines")]


def samples_with_description(spark, sf_dir):
    words = spark.createDataFrame(_DESCRIPTIONS, "config_name string, column_name string, description string")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in FEATURES])
    rows = samples(spark, sf_dir).select("hash", "config_name", F.explode(F.filter(cells, lambda x: x["value"] != 0)).alias("x")).select("hash", "config_name", "x.*")
    return rows.join(F.broadcast(words), ["config_name", "column_name"]).select("hash", "config_name", "column_name", "value", "description")  # four rows


def observation_join(spark, sf_dir):
    words = spark.createDataFrame([("l_quantity", "pieces"), ("l_returnflag", "state of return")], "column_name string, description string")
    return P.profile(_counts(spark, sf_dir)).join(F.broadcast(words), "column_name").select("column_name", "description", "row_count", "distinct_count")  # two rows


def class_weights(spark, sf_dir):
    return weights(samples(spark, sf_dir).filter("split_name = 'train'")).select("label", F.round("weight", _R).alias("weight"))


def row_fingerprint(spark, sf_dir):
    return P.table_digest(samples(spark, sf_dir))


QUERIES = {f.__name__: f for f in [
    stg_samples, label_summary, not_null_tests, partition_counts, table_stats, column_profile, distinct_exact, observed_domain, top_values, outlier_warning, split_class_counts, issue_rollup, bounded_examples, profile_drift,
    duplicate_apk, split_overlap, row_number_per_file, manifest_order, top_k_limit, union_batches, category_counts, dictionary_join, dictionary_orphans, samples_with_description, observation_join, class_weights, row_fingerprint,
]}

_num = lambda t, c: f"SELECT '{c}' AS column_name, count(*) AS row_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS non_finite, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 4) AS mean_value, round(stddev_pop({c}), 4) AS stddev_value FROM {t}"
_txt = lambda t, c: f"SELECT '{c}', count(*), CAST(count(*) - count({c}) AS BIGINT), CAST(0 AS BIGINT), NULL, NULL, NULL, NULL FROM {t}"
_DUP = """t AS (SELECT lower(upper(sha256(CAST(o_custkey AS VARCHAR)))) AS identity, 'orders' AS source_file, o_orderkey AS row_number, CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM orders),
w AS (SELECT *, first_value(split) OVER (PARTITION BY identity ORDER BY row_number) AS first_split, row_number() OVER (PARTITION BY identity ORDER BY row_number) AS k FROM t),
d AS (SELECT CASE WHEN split = first_split THEN 'DUPLICATE' ELSE 'SPLIT_OVERLAP' END AS code, identity, source_file, row_number, split, first_split FROM w WHERE k > 1)"""
_ISS = SAMPLES_SQL + ", iss AS (" + " UNION ALL ".join(f"SELECT source_file, row_number, 'error' AS severity, 'BINARY_DOMAIN' AS code, 'value' AS stage, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM samples WHERE {c} > 1" for c in FEATURES) + ")"
_top = lambda c: f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}"
_half = lambda k, name: " UNION ALL ".join(f"SELECT '{c}' AS column_name, unnest(['row_count', 'null_count', 'distinct_count']) AS field, unnest([CAST(count(*) AS VARCHAR), CAST(count(*) - count({c}) AS VARCHAR), CAST(count(DISTINCT {c}) AS VARCHAR)]) AS {name} FROM lineitem WHERE l_orderkey % 2 = {k}" for c in ("l_quantity", "l_linenumber", "l_returnflag"))

_SORTED = ("config_name", "dataset_id", "family", "feat_0", "feat_1", "feat_2", "hash", "label", "row_number", "source_file", "split_name", "vt_count", "year_month")

SQL = {
    "table_stats": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS holds_bytes FROM {t}" for t in ("orders", "lineitem", "events")),
    "row_fingerprint": f"WITH {SAMPLES_SQL}, j AS (SELECT sha256(CAST(json_object({', '.join(f"'{c}', {c}" for c in _SORTED)}) AS VARCHAR)) AS h FROM samples) SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(h, 1, 15) AS UBIGINT)) AS VARCHAR) AS digest FROM j",
    "stg_samples": f"WITH {SAMPLES_SQL} SELECT * FROM samples",
    "label_summary": f"WITH {SAMPLES_SQL} SELECT config_name, split_name, label, family, count(*) AS sample_count, round(avg(vt_count), {_R}) AS average_vt_count FROM samples GROUP BY ALL",
    "not_null_tests": f"WITH {SAMPLES_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM samples" for c in ["dataset_id", "config_name", "split_name", "hash", "label", "year_month"]),
    "partition_counts": f"WITH {SAMPLES_SQL} SELECT config_name, split_name, count(*) AS n_rows FROM samples GROUP BY 1, 2 ORDER BY 1, 2",
    "column_profile": " UNION ALL ".join([_num("customer", "c_acctbal"), _num("customer", "c_nationkey"), _txt("customer", "c_mktsegment"), _num("lineitem", "l_quantity"), _num("lineitem", "l_tax"), _num("lineitem", "l_linenumber"), _txt("lineitem", "l_returnflag")]),
    "distinct_exact": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM {t}" for t, cs in _PROFILED.items() for c in cs),
    "observed_domain": "SELECT * FROM (VALUES ('label', 'binary'), ('feat_0', 'nonnegative_integer'), ('family', 'non_numeric'), ('gone', 'unobserved'), ('signed', 'integer'), ('half', 'real'), ('nan', 'non_numeric')) AS t(column_name, observed_domain) WHERE EXISTS (SELECT 1 FROM orders)",
    "top_values": f"WITH c AS ({_top('l_linenumber')} UNION ALL {_top('l_returnflag')} UNION ALL {_top('l_suppkey')}), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank FROM c) SELECT column_name, rank, value, n FROM r WHERE rank <= 12",
    "outlier_warning": "WITH v AS (SELECT CASE WHEN event_id % 997 = 5 THEN 1000 ELSE event_id % 3 END AS x FROM events) SELECT 'spiked' AS column_name, CAST(max(x) AS DOUBLE) AS max_value FROM v HAVING max(x) > avg(x) + 8 * stddev_pop(x)",
    "split_class_counts": f"WITH {SAMPLES_SQL}, n AS (SELECT split_name, count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives FROM samples GROUP BY 1) SELECT *, negatives > 0 AND positives > 0 AS both_classes FROM n",
    "issue_rollup": f"WITH {_ISS}, k AS (SELECT *, row_number() OVER (PARTITION BY code, stage, feature ORDER BY source_file, row_number, value) AS r FROM iss) SELECT severity, code, stage, feature, count(*) AS count, string_agg(source_file || ':' || row_number || ':' || value, ',' ORDER BY r) FILTER (r <= 3) AS examples FROM k GROUP BY 1, 2, 3, 4",
    "bounded_examples": f"WITH {_ISS}, k AS (SELECT *, CAST(row_number() OVER (PARTITION BY code, feature ORDER BY source_file, row_number) AS INTEGER) AS rank FROM iss) SELECT code, feature, rank, source_file, row_number, value FROM k WHERE rank <= 5",
    "profile_drift": f"WITH b AS ({_half(0, 'before')}), a AS ({_half(1, 'after')}) SELECT a.column_name, a.field, b.before, a.after FROM a JOIN b USING (column_name, field) WHERE b.before IS DISTINCT FROM a.after",
    "duplicate_apk": f"WITH {_DUP} SELECT * FROM d",
    "split_overlap": f"WITH {_DUP} SELECT split, first_split, count(*) AS n FROM d WHERE code = 'SPLIT_OVERLAP' GROUP BY 1, 2",
    "row_number_per_file": "SELECT s_suppkey, row_number() OVER () - 1 AS row_number FROM supplier",
    "manifest_order": f"WITH {SAMPLES_SQL} SELECT DISTINCT config_name, source_file FROM samples ORDER BY 1, 2",
    "top_k_limit": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 12",
    "union_batches": "SELECT * FROM orders",
    "category_counts": f"WITH {_DICT} SELECT category, count(*) AS baseline, count(narrow_id) AS narrow FROM base LEFT JOIN narrow USING (token) GROUP BY 1",
    "dictionary_join": f"WITH {_DICT} SELECT column_name, token, category, narrow_id FROM base LEFT JOIN narrow USING (token)",
    "dictionary_orphans": f"WITH {_DICT} SELECT token, narrow_id FROM narrow WHERE token NOT IN (SELECT token FROM base WHERE category <> 'Brand#1' AND CAST(split_part(token, '_', -1) AS INTEGER) % 8 <> 0)",
    "samples_with_description": f"WITH {SAMPLES_SQL}, u AS (" + " UNION ALL ".join(f"SELECT hash, config_name, '{c}' AS column_name, {c} AS value FROM samples WHERE {c} <> 0" for c in FEATURES) + "), w(config_name, column_name, description) AS (VALUES " + ", ".join(str(r) for r in _DESCRIPTIONS) + ") SELECT hash, config_name, column_name, value, description FROM u JOIN w USING (config_name, column_name)",
    "observation_join": "SELECT 'l_quantity' AS column_name, 'pieces' AS description, count(*) AS row_count, count(DISTINCT l_quantity) AS distinct_count FROM lineitem UNION ALL SELECT 'l_returnflag', 'state of return', count(*), count(DISTINCT l_returnflag) FROM lineitem",
    "class_weights": f"WITH {SAMPLES_SQL}, n AS (SELECT label, count(*) AS n FROM samples WHERE split_name = 'train' GROUP BY 1) SELECT label, round(sum(n) OVER () / (2.0 * n), {_R}) AS weight FROM n",
}
