"""Scalar operators, splits, feature sets and plans over the samples view."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.operators import splits as P
from broadloom.operators.profile import not_binary_counts
from broadloom.operators.windows import apply_scaler, fit_scaler
from broadloom.plans import feature_plan as G
from broadloom.session import table
from broadloom.sources.views import FEATURES, SAMPLES_SQL, samples

SEED = "split-v1"


def _x(spark, sf_dir):
    """Supplier balances with nulls, as a column to transform."""
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("x"))


_X = "v AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS x FROM customer)"


def _op(value):
    return lambda spark, sf_dir: _x(spark, sf_dir).select("c_custkey", value(F.col("x")).alias("y"))


def op_cast(spark, sf_dir):
    return _x(spark, sf_dir).select("c_custkey", S.safe_cast(F.floor("x"), "smallint").cast("int").alias("y"), S.cast_failed(F.col("x"), "int").alias("failed"))


def missing_policy(spark, sf_dir):
    nodes = [G.Node("x@1", column="x", source="c", type="double"), G.Node("y@1", input="x@1", missing="constant", constant=-1.0, type="double"), G.Node("z@1", input="x@1", missing="error", type="double")]
    rows = G.FeaturePlan.compile(nodes, ["y@1", "z@1"]).apply(_x(spark, sf_dir), ["c_custkey"], checks=True)
    return rows.select("c_custkey", F.col("y_v1").alias("y"), F.col("z_v1__null").alias("violation"))


def binary_projection(spark, sf_dir):
    """Violations of the strict 0/1 contract, per feature."""
    return not_binary_counts(samples(spark, sf_dir), FEATURES).withColumnRenamed("column_name", "feature")


def hash_bucket(spark, sf_dir):
    return samples(spark, sf_dir).select("hash", S.hash_bucket(F.col("hash"), SEED).alias("bucket"))


def stable_hash_bucket(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.stable_hash_bucket(F.when(F.col("c_custkey") % 9 != 0, F.col("c_name"))).alias("bucket"))


def dataset_filter(spark, sf_dir):
    return samples(spark, sf_dir).filter((F.col("dataset_id") == "orders") & (F.col("config_name") == "narrow")).select("hash")


def split_hash(spark, sf_dir):
    return samples(spark, sf_dir).select("hash", P.split_hash(F.col("split_name"), F.col("hash"), SEED).alias("split"))


def split_temporal(spark, sf_dir):
    rows = samples(spark, sf_dir).select("hash", P.split_temporal(F.col("split_name"), F.col("year_month"), "1996-12", "1998-06").alias("split"))
    return P.with_policy(rows, "temporal-v1", train_through="1996-12", validation_through="1998-06")


def presence_features(spark, sf_dir):
    plan = G.FeaturePlan.compile(G.presence_nodes(FEATURES, "orders"), [f"{c}.presence@1" for c in FEATURES])
    rows = plan.apply(samples(spark, sf_dir), ["hash"])
    return rows.select("hash", *[F.col(f"{c}_presence_v1").cast("int").alias(c) for c in FEATURES])


def _graph():
    return [
        G.Node("f0.count@1", column="feat_0", source="orders", type="bigint"),
        G.Node("f0.present@1", input="f0.count@1", op="positive_presence", kind="binary"),
        G.Node("f1.count@1", column="feat_1", source="orders", type="bigint"),
        G.Node("f1.clip@1", input="f1.count@1", op="clip", params={"min": 0, "max": 2}, type="int"),
        G.Node("f1.log@2", input="f1.clip@1", op="log1p_nonnegative", type="double"),
    ]


_OUT = ["f0.present@1", "f1.clip@1", "f1.log@2"]


def feature_plan(spark, sf_dir):
    rows = G.FeaturePlan.compile(_graph(), _OUT).apply(samples(spark, sf_dir), ["hash"])
    return rows.select("hash", F.col("f0_present_v1").cast("int").alias("present"), F.col("f1_clip_v1").alias("clipped"), F.round("f1_log_v2", 6).alias("logged"))


def feature_lineage(spark, sf_dir):
    """Lineage of outputs, with how many samples each raw column has a value for."""
    plan = G.FeaturePlan.compile(_graph(), _OUT)
    chain = G.lineage(spark, plan.edges(spark), list(plan.outputs))
    n = samples(spark, sf_dir).agg(F.count("feat_0").alias("orders.feat_0"), F.count("feat_1").alias("orders.feat_1"))
    filled = n.select(F.explode(F.array(*[F.struct(F.lit(c).alias("node"), F.col(f"`{c}`").alias("filled")) for c in ("orders.feat_0", "orders.feat_1")])).alias("x")).select("x.*")
    return chain.join(filled, "node").select("output", "node", "depth", "filled")


def assemble_vector(spark, sf_dir):
    rows = samples(spark, sf_dir).select("hash", P.vector(FEATURES).alias("features"))
    return rows.select("hash", F.size("features").alias("width"), *[F.element_at("features", i + 1).cast("double").alias(f"x{i}") for i in range(len(FEATURES))])


def feature_set_layout(spark, sf_dir):
    """Columns of each storage type, and the samples they describe."""
    rows = samples(spark, sf_dir)
    groups = P.layout(rows, ["label", *FEATURES, "family"])
    cells = [F.struct(F.lit(t).alias("storage"), F.lit(",".join(c)).alias("columns")) for t, c in sorted(groups.items())]
    return rows.agg(F.count("*").alias("n")).select("n", F.explode(F.array(*cells)).alias("x")).select("x.*", "n")


_VARIANTS = {"full": {}, "no_f1": {"exclude": ["feat_1"]}, "swap": {"replace": {"feat_2": "vt_count"}}}


def ablation_variants(spark, sf_dir):
    return P.ablation_rows(samples(spark, sf_dir), "hash", P.ablations(FEATURES, _VARIANTS))


def standard_scaler_fit(spark, sf_dir):
    return fit_scaler(samples(spark, sf_dir).filter("split_name = 'train'"), FEATURES).select("column_name", F.round("mean_value", 6).alias("mean_value"), F.round("scale_value", 6).alias("scale_value"))


def standard_scaler_apply(spark, sf_dir):
    rows = samples(spark, sf_dir)
    scaled = apply_scaler(rows.select("hash", *FEATURES), fit_scaler(rows.filter("split_name = 'train'"), FEATURES), FEATURES)
    return scaled.select("hash", *[F.round(c, 4).alias(c) for c in FEATURES])


def flagship(spark, sf_dir):
    """Labels and present features by split: scan, join, hash split, presence and aggregate."""
    rows = samples(spark, sf_dir).withColumn("split", P.split_hash(F.col("split_name"), F.col("hash"), SEED))
    return rows.groupBy("config_name", "split", "label").agg(F.count("*").alias("n_rows"), F.round(F.avg("vt_count"), 6).alias("average_vt_count"), *[F.sum(S.presence(F.col(c))).alias(f"present_{c[-1]}") for c in FEATURES])


QUERIES = {
    "op_identity": _op(lambda x: x), "op_cast": op_cast, "op_positive_presence": _op(S.presence), "op_fill_null": _op(lambda x: S.fill_null(x, 0.5)), "op_clip": _op(lambda x: S.clip(x, 0.0, 5000.0)),
    "op_log1p_nonnegative": lambda spark, sf_dir: _x(spark, sf_dir).select("c_custkey", F.round(S.log1p_nonnegative(F.col("x")), 6).alias("y"), S.log1p_failed(F.col("x")).alias("failed")),
} | {f.__name__: f for f in [
    missing_policy, binary_projection, hash_bucket, stable_hash_bucket, dataset_filter, split_hash, split_temporal, presence_features, feature_plan, feature_lineage, assemble_vector, feature_set_layout, ablation_variants,
    standard_scaler_fit, standard_scaler_apply, flagship,
]}

_BUCKET = f"CAST(CAST('0x' || substr(sha256('{SEED}:' || hash), 1, 16) AS UBIGINT) % 10000 AS INTEGER)"
_SPLIT = f"CASE WHEN split_name = 'test' THEN 'test' WHEN {_BUCKET} < 2000 THEN 'validation' ELSE 'train' END"
_state = lambda c: f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"

_low = "4294967295"
_rotl = lambda x, r: f"((({x} << {r}) | ({x} >> {32 - r})) & {_low})"
_mixed = lambda k: f"(({_rotl(f'(({k} * 3432918353) & {_low})', 15)} * 461845907) & {_low})"
_step = lambda x, shift, by: f"((xor({x}, {x} >> {shift}) * {by}) & {_low})"
#: MurmurHash3 (x86, 32 bits, seed 1847) of ASCII names: whole words by a fold, the tail, the final mix.
_MURMUR = f"""WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS s FROM customer),
b AS (SELECT c_custkey, length(s) AS n, list_transform(range(0, length(s)), lambda i: CAST(ord(substr(s, CAST(i AS INTEGER) + 1, 1)) AS UBIGINT)) AS b FROM n),
w AS (SELECT c_custkey, n, list_transform(range(0, n // 4), lambda i: b[4 * i + 1] | (b[4 * i + 2] << 8) | (b[4 * i + 3] << 16) | (b[4 * i + 4] << 24)) AS words,
 CAST(coalesce(list_sum(list_transform(range(0, n % 4), lambda i: b[4 * (n // 4) + i + 1] << CAST(8 * i AS UBIGINT))), 0) AS UBIGINT) AS tail FROM b),
h AS (SELECT c_custkey, n, tail, list_reduce(list_concat([CAST(1847 AS UBIGINT)], words), lambda a, k: ({_rotl(f'xor(a, {_mixed("k")})', 13)} * 5 + 3864292196) & {_low}) AS h FROM w),
t AS (SELECT c_custkey, xor(xor(h, {_mixed("tail")}), CAST(n AS UBIGINT)) AS h FROM h), u AS (SELECT c_custkey, {_step("h", 16, 2246822507)} AS h FROM t), v AS (SELECT c_custkey, {_step("h", 13, 3266489909)} AS h FROM u)
SELECT c_custkey, coalesce(CAST(xor(h, h >> 16) % 65536 AS INTEGER), 0) AS bucket FROM v"""

SQL = {
    "op_identity": f"WITH {_X} SELECT c_custkey, x AS y FROM v",
    "op_cast": f"WITH {_X} SELECT c_custkey, CAST(TRY_CAST(floor(x) AS SMALLINT) AS INTEGER) AS y, coalesce(x IS NOT NULL AND x <> floor(x), false) AS failed FROM v",
    "op_positive_presence": f"WITH {_X} SELECT c_custkey, CASE WHEN x > 0 THEN 1 WHEN x <= 0 THEN 0 END AS y FROM v",
    "op_fill_null": f"WITH {_X} SELECT c_custkey, coalesce(x, 0.5) AS y FROM v",
    "op_clip": f"WITH {_X} SELECT c_custkey, CASE WHEN x < 0 THEN 0 WHEN x > 5000 THEN 5000 ELSE x END AS y FROM v",
    "op_log1p_nonnegative": f"WITH {_X} SELECT c_custkey, CASE WHEN x >= 0 THEN round(ln(1 + x), 6) END AS y, coalesce(x < 0, false) AS failed FROM v",
    "missing_policy": f"WITH {_X} SELECT c_custkey, coalesce(x, -1) AS y, x IS NULL AS violation FROM v",
    "stable_hash_bucket": _MURMUR,
    "assemble_vector": f"WITH {SAMPLES_SQL} SELECT hash, 3 AS width, " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(FEATURES)) + " FROM samples",
    "binary_projection": f"WITH {SAMPLES_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER ({c} NOT IN (0, 1)) AS violations FROM samples" for c in FEATURES),
    "hash_bucket": f"WITH {SAMPLES_SQL} SELECT hash, {_BUCKET} AS bucket FROM samples",
    "dataset_filter": f"WITH {SAMPLES_SQL} SELECT hash FROM samples WHERE config_name = 'narrow'",
    "split_hash": f"WITH {SAMPLES_SQL} SELECT hash, {_SPLIT} AS split FROM samples",
    "split_temporal": f"WITH {SAMPLES_SQL} SELECT hash, CASE WHEN year_month <= '1996-12' THEN 'train' WHEN year_month <= '1998-06' THEN 'validation' ELSE 'test' END AS split, 'temporal-v1' AS split_policy, 'train_through=1996-12,validation_through=1998-06' AS split_inputs FROM samples",
    "presence_features": f"WITH {SAMPLES_SQL} SELECT hash, " + ", ".join(f"CAST({c} > 0 AS INTEGER) AS {c}" for c in FEATURES) + " FROM samples",
    "feature_plan": f"WITH {SAMPLES_SQL} SELECT hash, CAST(feat_0 > 0 AS INTEGER) AS present, CAST(least(feat_1, 2) AS INTEGER) AS clipped, round(ln(1 + least(feat_1, 2)), 6) AS logged FROM samples",
    "feature_lineage": "WITH RECURSIVE e(feature, parent) AS (VALUES ('f0.count@1', 'orders.feat_0'), ('f0.present@1', 'f0.count@1'), ('f1.count@1', 'orders.feat_1'), ('f1.clip@1', 'f1.count@1'), ('f1.log@2', 'f1.clip@1')), c(output, node, depth) AS (SELECT feature, parent, 1 FROM e WHERE feature IN ('f0.present@1', 'f1.clip@1', 'f1.log@2') UNION ALL SELECT c.output, e.parent, c.depth + 1 FROM c JOIN e ON e.feature = c.node) SELECT output, node, depth, (SELECT count(*) FROM orders) AS filled FROM c WHERE node LIKE 'orders.%'",
    "feature_set_layout": "SELECT storage, columns, (SELECT count(*) FROM orders) AS n FROM (VALUES ('bigint', 'feat_0,feat_1,feat_2'), ('int', 'label'), ('string', 'family')) AS t(storage, columns)",
    "ablation_variants": f"WITH {SAMPLES_SQL} " + " UNION ALL ".join(f"SELECT '{v}' AS variant, hash, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM samples" for v, cs in P.ablations(FEATURES, _VARIANTS).items() for c in cs),
    "standard_scaler_fit": f"WITH {SAMPLES_SQL}, t AS (SELECT * FROM samples WHERE split_name = 'train') " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean_value, round(stddev_pop({c}), 6) AS scale_value FROM t" for c in FEATURES),
    "standard_scaler_apply": f"WITH {SAMPLES_SQL}, st AS (SELECT {', '.join(_state(c) for c in FEATURES)} FROM samples WHERE split_name = 'train') SELECT hash, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 4) AS {c}" for c in FEATURES) + " FROM samples, st",
    "flagship": f"WITH {SAMPLES_SQL} SELECT config_name, {_SPLIT} AS split, label, count(*) AS n_rows, round(avg(vt_count), 6) AS average_vt_count, " + ", ".join(f"CAST(sum(CAST({c} > 0 AS INTEGER)) AS BIGINT) AS present_{c[-1]}" for c in FEATURES) + " FROM samples GROUP BY 1, 2, 3",
}
