"""Edges of the library's operators that the tables do not show."""

import math

import pytest
from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.functions import text as T
from broadloom.operators import evaluation as E
from broadloom.operators import profile as P
from broadloom.operators import splits, windows
from broadloom.plans import audit as A
from broadloom.plans import feature_plan as G
from broadloom.queries import sources
from broadloom.session import scratch
from broadloom.sources import copies, scans
from tests.oracle import connect, difference


def col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_murmur_vectors(spark):
    # Published MurmurHash3 x86 32-bit vectors, seed 0.
    known = {"": 0, "a": 0x3C2569B2, "abc": 0xB3DD93FA, "hello": 0x248BFA47, "The quick brown fox jumps over the lazy dog": 0x2E4FF723}
    df = spark.createDataFrame([(k, v) for k, v in known.items()], "t string, want long")
    assert df.filter(S.murmur3_32(F.col("t"), 0) != F.col("want")).isEmpty()
    assert col(spark.createDataFrame([(None,)], "t string"), S.stable_hash_bucket(F.col("t"))) == [0]


def test_scalars(spark):
    df = spark.createDataFrame([(1.5,), (2.0,), (None,), (float("nan"),), (float("inf"),), (1e300,), (-2.0,)], "x double").coalesce(1)
    x = F.col("x")
    assert col(df, S.safe_cast(x, "int")) == [None, 2, None, None, None, None, -2]
    assert col(df, S.cast_failed(x, "int")) == [True, False, False, True, True, True, False]
    assert col(df, S.presence(x)) == [1, 1, None, 0, 1, 1, 0]
    clipped = col(df, S.clip(x, 0.0, 2.0))
    assert clipped[:3] == [1.5, 2.0, None] and math.isnan(clipped[3]) and clipped[4:] == [2.0, 2.0, 0.0]
    assert col(df, S.log1p_failed(x)) == [False] * 6 + [True]
    with pytest.raises(ValueError):
        S.clip(x, 2, 1)


def test_log_lines(spark):
    lines = ["03-17 16:13:38.811  1702  2395 D WindowManager: printFreezing: x", "03-17 16:13:38.819  1702  8671 D no component here", "not a log line"]
    df = T.parse_log(spark.createDataFrame([(x,) for x in lines], "raw_line string").coalesce(1))
    got = df.select("date", "pid", "tid", "level", "component", "content").collect()
    assert tuple(got[0]) == ("03-17", 1702, 2395, "D", "WindowManager", "printFreezing: x")
    assert got[1].component is None and got[1].content == "no component here" and all(v is None for v in got[2])


def test_read_log(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\r\ntwo\n\nfour")
    rows = scans.read_log(spark, str(tmp_path / "a.log")).orderBy("line_number").collect()
    assert [(r.line_number, r.raw_line) for r in rows] == [(1, "one"), (2, "two"), (3, ""), (4, "four")]
    assert scans.read_log(spark, str(tmp_path / "a.log"), 2).count() == 2


def test_redaction(spark):
    cases = {
        "api_key = abc123 rest": "api_key = <REDACTED> rest",
        '{"my_token": "a b c", "n": 1}': '{"my_token": <REDACTED>, "n": 1}',
        "--password hunter2 x": "--password <REDACTED> x",
        "Authorization: Bearer abc.def": "Authorization: <REDACTED> <REDACTED>",
        "sk-abcdefghijklmnop": "<REDACTED_KEY>",
        "nothing to see": "nothing to see",
        '{"a": {"token": [1, {"b": "]"}], "c": 2}}': '{"a": {"token": <REDACTED>, "c": 2}}',
        "secret=[1, {2": "secret=<REDACTED>",
        "password='it\\'s' x": "password=<REDACTED> x",
        "p" * 5000 + "token" + "q" * 5000 + "=abc&n=1": "p" * 5000 + "token" + "q" * 5000 + "=<REDACTED>&n=1",
        'token="' + "a" * 20000: "token=<REDACTED>",
        "tokens are good: yes": "tokens are good: yes",
        '\\"my-secret\\": \\"a b\\", c': '\\"my-secret\\": <REDACTED>, c',
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert [(r.t, r.got) for r in df.select("t", T.redact(F.col("t"), None).alias("got"), "want").filter("got <> want").collect()] == []
    assert col(spark.createDataFrame([("x" * 9000,)], "t string"), F.length(T.redact(F.col("t")))) == [6000]


def test_urls(spark):
    cases = {"1.2.3.4:80/x": "ip", "http://a.no-ip.org": "dynamic_dns", "bit.ly/x": "shortener", "http://www.w3.org/a": "namespace", "ads.vungle.com": "advertising", "x.sentry.io": "analytics", "API.GitHub.com": "platform", "own.example": "other", None: None}
    df = spark.createDataFrame(list(cases.items()), "u string, want string")
    assert df.filter(~T.classify_url(F.col("u")).eqNullSafe(F.col("want"))).isEmpty()


def test_plan_errors():
    raw = G.Node("a@1", column="x", source="s")
    for nodes, outputs in [
        ([raw, raw], ["a@1"]), ([raw], ["b@1"]), ([G.Node("a@1", input="b@1"), G.Node("b@1", input="a@1")], ["a@1"]), ([G.Node("a@1", column="label", source="s")], ["a@1"]),
        ([raw, G.Node("b@1", input="a@1", op="clip", params={"min": 0})], ["b@1"]), ([raw, G.Node("b@1", input="a@1", op="nope")], ["b@1"]),
        ([raw, G.Node("c@1", column="y", source="t")], ["a@1", "c@1"]), ([G.Node("a", column="x", source="s")], ["a"]),
    ]:
        with pytest.raises(ValueError):
            G.FeaturePlan.compile(nodes, outputs)
    with pytest.raises(ValueError):
        G.register("clip", (), lambda x, p: x)


def test_audit_missing_and_duplicate_columns(spark):
    df = spark.createDataFrame([("a", 1)], "hash string, label int")
    plan = G.FeaturePlan.compile([G.Node("f@1", column="f", source="s")], ["f@1"])
    found = {(r.code, r.feature) for r in A.contract_audit(df, plan, "d", "c", {"hash": "string", "label": "bigint"}).collect()}
    assert found == {("MISSING_COLUMN", "f"), ("METADATA_TYPE", "label")}
    twice = df.select("hash", "hash", "label")
    assert [r.feature for r in A.schema_issues(twice, [], {}).collect()] == ["hash"]


def test_audit_empty(spark):
    df = spark.createDataFrame([], "hash string, label int, split_name string, year_month string, dataset_id string, config_name string, f double, source_file string, row_number long")
    plan = G.FeaturePlan.compile([G.Node("f@1", column="f", source="s")], ["f@1"])
    assert [(r.code, r.feature) for r in A.contract_audit(df, plan, "d", "c", {}).orderBy("code", "feature").collect()] == [("EMPTY_DATASET", None), ("SPLIT_CLASSES", "test"), ("SPLIT_CLASSES", "train")]


def test_audit_reads_the_table_once_for_all_conditions(spark):
    path, n = scratch(spark), 600
    spark.range(20).select("id", *[(F.col("id") % 3).alias(f"f{k}") for k in range(n)]).write.parquet(path)
    checks = [("error", "X", "value", f"f{k}", F.col(f"f{k}") > 1) for k in range(n)]
    counted = A.count_checks(spark.read.parquet(path), checks)
    assert counted._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert counted.groupBy("count").count().collect() == [(6, n)]
    some = A.count_checks(spark.read.parquet(path).selectExpr("*", "'a' source_file", "id row_number"), checks[:2], 2).collect()
    assert [r.examples for r in some] == [["a:2:2", "a:5:2"]] * 2


def test_audit_of_a_scan_that_fails(spark):
    df = spark.range(3).select(F.raise_error(F.lit("secret address")).alias("severity"))
    issues, done = A.run_audit(spark, lambda: df)
    rows = issues.collect()
    assert not done and [r.code for r in rows] == ["SCAN_FAILED"] and "secret" not in str(rows)
    assert A.certify(issues, done, {}).first().status == "failed"


def test_certificates(spark):
    issues = spark.createDataFrame([("warning", "X", "s", "f", 2)], A.ISSUES)
    ok = A.certify(issues, True, {"contract": "a"})
    A.require_certified(ok, {"contract": "a"})
    for certificate, binding in [(ok, {"contract": "b"}), (A.certify(issues, False, {"contract": "a"}), {"contract": "a"}), (A.certify(issues.withColumn("severity", F.lit("error")), True, {"contract": "a"}), {"contract": "a"})]:
        with pytest.raises(ValueError):
            A.require_certified(certificate, binding)
    assert A.certify(issues, False, {}).first().status == "advisory"


def test_publish_refuses_conflicts(spark):
    path, df = scratch(spark), spark.createDataFrame([("c", 1)], "column_name string, n int")
    assert A.publish(spark, df, path, "a", True) == 2 and A.publish(spark, df, path, "a", True) == 0
    with pytest.raises(ValueError):
        A.publish(spark, df.withColumn("n", F.lit(2)), path, "a", True)
    with pytest.raises(ValueError):
        A.publish(spark, df.limit(0), path, "b", True)


def test_recovery_refusals(spark):
    source = spark.createDataFrame([("a", i) for i in range(7)] + [("b", i) for i in range(4)], "source_file string, row_number long")
    path = scratch(spark)
    source.filter("row_number in (0, 1, 3)").write.parquet(path)
    with pytest.raises(ValueError):
        copies.recover(spark, source, path, "x", "y")
    with pytest.raises(ValueError):
        copies.recover(spark, source.union(source.limit(1)), path, "x", "x")
    with pytest.raises(ValueError):
        copies.recover(spark, source.filter("row_number > 0"), path, "x", "x")
    assert copies.recover(spark, source, path, "x", "x") == {"before": 6, "appended": 5, "after": 11}
    assert copies.recover(spark, source, path, "x", "x")["appended"] == 0
    gone = copies.missing_ranges(spark.createDataFrame([("a", i) for i in (1, 2, 3, 7, 9, 10)], "source_file string, row_number long"), 4)
    assert sorted((r.first_row, r.last_row, r.n_rows) for r in gone.collect()) == [(1, 3, 3), (7, 7, 1), (9, 10, 2)]


def test_sinks(spark):
    path, empty = scratch(spark), spark.createDataFrame([], "a int, b string")
    copies.chunked_copy(empty, path)
    assert spark.read.parquet(path).columns == ["a", "b"]
    copies.write_once(empty, path + "x")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        copies.write_once(empty, path + "x")
    with pytest.raises(ValueError):
        copies.select_tables(["p_a"], "p_", ["p_b"])
    with pytest.raises(ValueError):
        scans.require_rows(empty)


def test_deletes_count_physical_rows(spark):
    path = scratch(spark)
    spark.range(40).select("id", F.when(F.col("id") % 3 == 0, "other").otherwise("base").alias("config_name")).coalesce(1).write.parquet(path)
    rows = scans.with_provenance(spark.read.parquet(path).withColumnRenamed("config_name", "kind"), "d", "c", "s")
    gone = rows.filter(F.col("row_number").isin(4, 7, 12, 16, 39)).select("source_file", "row_number")
    kept = scans.without_deleted(rows, gone).filter("kind = 'base'")
    assert sorted(col(kept, "id")) == [i for i in range(40) if i % 3 and i not in (4, 7, 12, 16, 39)]


def test_pins_ignore_later_files(spark):
    path = scratch(spark)
    spark.range(5).write.parquet(path)
    pin = scans.PinnedTable.of(spark.read.parquet(path))
    spark.range(5, 9).write.mode("append").parquet(path)
    assert pin.read(spark).count() == 5 and scans.PinnedTable.of(spark.read.parquet(path)).fingerprint != pin.fingerprint


def test_metrics_edges(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.6), (1, 0.9)], "label int, score double")
    curve = E.score_curve(df, parts=2)
    assert E.average_precision(curve).first()[0] == pytest.approx(1 * 0.5 + 0.5 * 2 / 3)
    assert E.roc_auc(curve).first()[0] == pytest.approx(0.75)
    assert E.f1_threshold(curve).first().threshold == 0.4
    one = df.filter("label = 1")
    assert E.roc_auc(E.score_curve(one)).first()[0] is None and E.confusion(one, 0.5).first().fpr is None


def test_profile_edges(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (4, None), (3, None), (5, None), (None, None), (None, None)], "a int, gone int")
    got = {r.column_name: r for r in P.profile(P.value_counts(df, ["a", "gone"])).collect()}
    assert (got["a"].distinct_count, got["a"].null_count, got["a"].min_value, got["a"].max_value) == (5, 2, 1, 5)
    assert got["a"].stddev_value == pytest.approx(1.4907119849998598) and got["gone"].observed_domain == "unobserved"


def test_identity_case_and_null_split(spark):
    rows = [("f", 0, "AB", "train"), ("f", 1, "ab", "train"), ("f", 2, "ab", None), ("g", 0, None, "train")]
    df = spark.createDataFrame(rows, "source_file string, row_number long, hash string, split_name string")
    assert sorted((r.row_number, r.code) for r in P.identity_issues(df).collect()) == [(1, "DUPLICATE"), (2, "SPLIT_OVERLAP")]


def test_splits(spark):
    df = spark.createDataFrame([("train", "2021-03"), ("test", "2023-01"), ("other", "2021-01"), ("train", "2021-13"), (None, None)], "s string, m string").coalesce(1)
    assert col(df, splits.split_temporal(F.col("s"), F.col("m"), "2021-12", "2022-06")) == ["train", "test", None, None, None]
    assert col(df, splits.split_hash(F.col("s"), F.col("m"), "x"))[1:3] == ["test", None]
    with pytest.raises(ValueError):
        splits.split_temporal(F.col("s"), F.col("m"), "2022-06", "2021-12")
    with pytest.raises(ValueError):
        splits.ablations(["a"], {"v": {"exclude": ["b"]}})


def test_trailing_split_equals_plain(spark):
    rows = [(1, i * 700_000, i) for i in range(200)] + [(1, 5_000_000, 7), (1, 5_000_000, 8)]
    df = spark.createDataFrame(rows, "k int, us long, v int").withColumn("ts", F.timestamp_micros("us"))
    for closed in windows.CLOSED:
        a = windows.trailing_sum(df, "k", "ts", "v", 3_000_000, closed).select("us", "v", "total")
        b = windows.trailing_sum_split(df, "k", "ts", "v", 3_000_000, closed, cell_us=5_000_000).select("us", "v", "total")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_dictionary_payloads_are_bounded(spark):
    from broadloom.queries import sources

    parts = spark.range(4000).selectExpr("concat('Part_', id) token", "'n' p_name", "'t' p_type", "concat('b', id % 2) p_brand")
    got = sources._payloads(parts, 500).collect()
    sizes = [len(r.features) for r in got if r.features]
    assert sum(sizes) == 4000 and max(sizes) <= 500 and sorted(c.name for r in got for c in r.categories or []) == ["b0", "b1"]


def test_dictionary_files_follow_rows_not_brands(spark):
    parts = spark.range(4000).selectExpr("concat('Part_', id) token", "'n' p_name", "'t' p_type", "concat('b', id % 50) p_brand")
    got = sources._payloads(parts, 500)
    sizes = [len(r.features) for r in got.collect() if r.features]
    assert sum(sizes) == 4000 and max(sizes) <= 500 and len(sizes) <= 12
    # payloads are dealt over tasks, however few bytes they have
    assert got.filter("features IS NOT NULL").groupBy(F.spark_partition_id()).count().count() > 1


def test_dictionary_with_schemas_equals_one_without(spark, tmp_path):
    parts = spark.range(300).selectExpr("concat('Part_', id) token", "concat('n', id) p_name", "'t' p_type", "concat('b', id % 3) p_brand")
    sources._payloads(parts, 100).write.option("maxRecordsPerFile", 1).json(f"{tmp_path}/json")
    parts.selectExpr("token", "concat('feat_', token) column_name").write.option("header", "true").csv(f"{tmp_path}/csv")
    plain = copies.load_dictionary(spark, f"{tmp_path}/csv", f"{tmp_path}/json", {"v": "1"})
    given = copies.load_dictionary(spark, f"{tmp_path}/csv", f"{tmp_path}/json", {"v": "1"}, sources._PAYLOAD, "token string, column_name string")
    for name, n in (("features", 300), ("categories", 3), ("columns", 3)):
        assert given[name].count() == n and plain[name].select(*given[name].columns).exceptAll(given[name]).isEmpty()


def test_asof_in_cells_equals_plain(spark):
    rng = __import__("random").Random(4)
    points = [(i, rng.randrange(3), rng.randrange(1000)) for i in range(300)] + [(900, None, 5), (901, 1, None)]
    features = {(rng.randrange(3), rng.randrange(1000)): k for k in range(60)}
    p = spark.createDataFrame(points, "id int, k int, s long").withColumn("at", F.timestamp_seconds("s"))
    f = spark.createDataFrame([(*a, v) for a, v in features.items()], "k int, s long, v int").withColumn("available", F.timestamp_seconds("s")).drop("s")
    got = {r.id: r.v for r in windows.asof_join(p, f, "k", "at", "available", ["v"], cell_us=50_000_000).collect()}
    for i, k, s in points:
        known = [(t, v) for (key, t), v in features.items() if key == k and s is not None and t <= s]
        assert got[i] == (max(known)[1] if known else None)
    assert windows.asof_join(p.limit(0), f, "k", "at", "available", ["v"]).count() == 0


def test_trailing_sides_share_one_scan_and_keep_columns(spark):
    path = scratch(spark)
    spark.range(50).selectExpr("id % 2 k", "timestamp_seconds(id) ts", "id v", "id own", "id cell").write.parquet(path)
    out = windows.trailing_sums_split(spark.read.parquet(path), "k", "ts", "v", 5_000_000, {c: c for c in windows.CLOSED})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert out.filter("own <> v OR cell <> v").isEmpty() and out.count() == 50


def test_nested_redaction(spark):
    import json

    from broadloom.functions import text

    deep = "x"
    for k in range(60):
        deep = {"token" if k == 40 else "k": deep}
    cases = [
        None, "", "{", '{"a": ', "[]", '"password=hunter22x"', "12", "null", "true",
        json.dumps({"a": [{"b": {"api_key": {"c": 1}, "d": [None, True, 1.5, "Bearer abcdefgh12345"]}}], "My.Token": None}),
        json.dumps({"out": json.dumps(json.dumps({"secret": "q", "n": [1]}))}),
        json.dumps(deep), "[" * 3000 + "]" * 3000,
    ]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, t string").coalesce(1)
    got = [r.r for r in df.select("k", text.redact_json(F.col("t")).alias("r")).orderBy("k").collect()]
    assert got[:5] == [None, "", "{", '{"a": ', "[]"] and got[6:9] == ["12", "null", "true"] and "hunter" not in got[5]
    assert json.loads(got[9]) == {"a": [{"b": {"api_key": "<REDACTED>", "d": [None, True, 1.5, "Bearer <REDACTED>"]}}], "My.Token": "<REDACTED>"}
    assert json.loads(json.loads(json.loads(got[10])["out"])) == {"secret": "<REDACTED>", "n": [1]}
    assert got[11].count("k") >= 18 and got[12]


def test_manifest_counts_the_parts_of_a_shard_together(spark, tmp_path):
    rows = spark.range(40)
    top = tmp_path / "all.parquet"  # the folder's own name is not a shard's
    rows.repartition(4).write.parquet(f"{top}/wide/2013_train.parquet")
    rows.withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(f"{top}/wide/2014_test.parquet")
    rows.coalesce(1).toPandas().to_parquet(f"{top}/one.parquet")
    got = {r.file_name: r for r in scans.file_manifest(spark, str(top)).collect()}
    assert {n: (r.config_name, r.split_name) for n, r in got.items()} == {"2013_train.parquet": ("wide", "train"), "2014_test.parquet": ("wide", "test"), "one.parquet": ("all.parquet", None)}
    assert got["2013_train.parquet"].n_files == 4 and got["one.parquet"].n_files == 1
    assert got["2014_test.parquet"].bytes == sum(p.stat().st_size for p in (top / "wide" / "2014_test.parquet").rglob("*.parquet"))
    assert [r.file_name for r in scans.file_manifest(spark, f"file://{top}/", ["wide"]).collect()] == ["2013_train.parquet", "2014_test.parquet"]


def test_manifest_equals_sql_on_tables_in_parts(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5).coalesce(1).toPandas().to_parquet(f"{tmp_path}/extra.parquet")
    assert difference(spark, connect(str(tmp_path)), str(tmp_path), sources.file_manifest, sources.SQL["file_manifest"]) is None
