"""Scans, sinks, copies and recovery over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.session import scratch, table, write_read
from broadloom.sources import copies, scans
from broadloom.sources.snapshots import SnapshotTable
from broadloom.sources.views import LOG_SQL, SAMPLES_SQL, device_events, log_lines, samples

#: Rows of a table in scan order with their physical position, as the oracle sees them.
_EV = "ev AS (SELECT *, row_number() OVER () - 1 AS row_number, 'events.parquet' AS source_file FROM events)"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.with_provenance(table(spark, sf_dir, "events"), "stream", "wide", "train")


def file_manifest(spark, sf_dir):
    return scans.file_manifest(spark, sf_dir).select("file_name", "split_name", (F.col("bytes") > 0).alias("holds_bytes"))


def ingest_provenance(spark, sf_dir):
    return scans.with_provenance(table(spark, sf_dir, "orders").withColumn("config_name", F.lit("old")), "shop", "wide", "train").select("dataset_id", "config_name", "split_name", "row_number", "source_file", "o_orderkey")


def limit_per_file(spark, sf_dir):
    return scans.limit_per_file(_events(spark, sf_dir), 100).select("source_file", "row_number", "event_id")


def max_files(spark, sf_dir):
    return scans.first_files(_events(spark, sf_dir), 1).groupBy("source_file").agg(F.count("*").alias("n_rows"))


def hub_rows_stream(spark, sf_dir):
    return scans.first_rows_per_split(samples(spark, sf_dir), 25, ["hash"], ["train"]).select("config_name", "split_name", "hash")


def pinned_scan(spark, sf_dir):
    pinned = scans.PinnedTable.of(write_read(samples(spark, sf_dir)))
    return pinned.read(spark, ["hash", "label", "feat_0"], "orders", "wide")


def audit_scan(spark, sf_dir):
    return scans.PinnedTable.of(write_read(samples(spark, sf_dir))).read(spark, None, "orders", "narrow").drop("source_file", "row_number")


def delete_aware_scan(spark, sf_dir):
    rows = _events(spark, sf_dir)
    deletes = rows.filter(F.col("event_id") % 13 == 0).select("source_file", "row_number")
    return scans.without_deleted(rows, deletes).filter("event_type = 'click'").select("event_id", "row_number")


def schema_evolution_scan(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    return scans.evolve(old, {"balance": "c_acctbal"}, {"c_region": "unknown"})


def snapshot_scan(spark, sf_dir):
    """Two snapshots of customers: the second renames a column and adds rows and a column."""
    t = SnapshotTable(spark, scratch(spark))
    rows = table(spark, sf_dir, "customer")
    t.commit(rows.filter("c_custkey % 3 > 0").select("c_custkey", F.col("c_acctbal").alias("balance")))
    t.commit(rows.filter("c_custkey % 3 = 0").select("c_custkey", "c_acctbal", "c_mktsegment"), {"balance": "c_acctbal"})
    first = t.read(1, ["c_custkey", "balance"]).select(F.lit(1).alias("snapshot"), "c_custkey", F.col("balance").alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"))
    return first.unionByName(t.read(2).select(F.lit(2).alias("snapshot"), "c_custkey", "c_acctbal", "c_mktsegment"))


def drop_loader_columns(spark, sf_dir):
    return scans.drop_loader_columns(table(spark, sf_dir, "supplier").withColumns({"_dlt_load_id": F.lit("x"), "_dlt_id": F.lit(1)}))


def log_scan(spark, sf_dir):
    path = scratch(spark)
    log_lines(table(spark, sf_dir, "events")).select("raw_line").write.text(path)
    lines = scans.read_log(spark, path)
    return lines.agg(F.count("*").alias("n_lines"), F.countDistinct("source_file", "line_number").alias("n_places"), F.count_if(F.col("raw_line").startswith("unparsed")).alias("unparsed"), F.sum(F.length("raw_line")).alias("n_chars"))


def predict_scan(spark, sf_dir):
    return scans.require_rows(samples(spark, sf_dir).select("feat_0", "feat_1", "feat_2", "config_name", "dataset_id", "hash"))


def replace_table(spark, sf_dir):
    path = scratch(spark)
    copies.replace_table(table(spark, sf_dir, "nation").limit(3), path)
    copies.replace_table(table(spark, sf_dir, "nation"), path)
    return spark.read.parquet(path)


def grouped_replace_append(spark, sf_dir):
    path, orders = scratch(spark), table(spark, sf_dir, "orders")
    copies.grouped_write([orders.filter(F.col("o_orderkey") % 9 == k) for k in range(9)], path, 4)
    return spark.read.parquet(path)


def chunked_copy(spark, sf_dir):
    path = scratch(spark)
    copies.chunked_copy(table(spark, sf_dir, "part"), path, 500)
    return spark.read.parquet(path)


def copy_verify(spark, sf_dir):
    """Reports of a whole copy and of one that lacks every eleventh order's lines."""
    source = table(spark, sf_dir, "lineitem")
    short = copies.copy_report(source, write_read(source.filter(F.col("l_orderkey") % 11 != 0)), "lineitem_short")
    return copies.copy_report(source, write_read(source), "lineitem").unionByName(short)


_KEYS = ["l_orderkey", "l_linenumber"]


def _lines(spark, sf_dir):
    """The distinct line keys, and a copy that an interruption left incomplete."""
    source = table(spark, sf_dir, "lineitem").dropDuplicates(_KEYS).select(F.col("l_orderkey").alias("row_number"), F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("source_file"))
    return source, source.filter(F.col("row_number") % 11 != 0)


_LINES = """src AS (SELECT DISTINCT l_orderkey AS row_number, 'line' || CAST(l_linenumber AS VARCHAR) AS source_file FROM lineitem), dst AS (SELECT * FROM src WHERE row_number % 11 <> 0)"""


def key_inventory(spark, sf_dir):
    return copies.key_inventory(table(spark, sf_dir, "lineitem"), _KEYS)


def foreign_keys(spark, sf_dir):
    source, copy = _lines(spark, sf_dir)
    extra = source.filter(F.col("row_number") % 50 == 0).withColumn("row_number", -F.col("row_number") - 1)
    return copies.foreign_keys(copy.unionByName(extra), source)


def missing_keys(spark, sf_dir):
    source, copy = _lines(spark, sf_dir)
    return copies.missing_keys(copy, source)


def missing_ranges(spark, sf_dir):
    source, copy = _lines(spark, sf_dir)
    return copies.missing_ranges(source.join(copy.filter(F.floor(F.col("row_number") / 40) % 3 != 0), copies.KEYS, "left_anti"), 64)


def key_range_filter(spark, sf_dir):
    source, copy = _lines(spark, sf_dir)
    return copies.in_ranges(source, copies.missing_ranges(copies.missing_keys(copy, source)))


def recover_rows(spark, sf_dir):
    source, copy = _lines(spark, sf_dir)
    source, path = write_read(source), scratch(spark)
    copy.write.parquet(path)
    pin = scans.PinnedTable.of(source).fingerprint
    copies.recover(spark, source, path, pin, pin)
    copies.recover(spark, source, path, pin, pin)
    return spark.read.schema(source.schema).parquet(path)


def keys_equal(spark, sf_dir):
    """Keys of an incomplete copy with foreign and repeated rows against its source, counted by file, before and after recovery."""
    source, copy = _lines(spark, sf_dir)
    path, sound = scratch(spark), write_read(copy)
    sound.write.parquet(path)
    copies.recover(spark, write_read(source), path, "s", "s")
    after = copies.keys_equal(spark.read.schema(source.schema).parquet(path), source)
    extra = sound.filter(F.col("row_number") % 50 == 0)
    broken = sound.unionByName(extra).unionByName(extra.withColumn("row_number", -F.col("row_number") - 1))
    c, s = F.col("in_copy"), F.col("in_source")
    return copies.key_differences(broken, source).groupBy("source_file").agg(
        F.count_if(c == 0).alias("missing"), F.count_if(s == 0).alias("foreign"), F.count_if((s > 0) & (c > s)).alias("repeated"), F.lit(after).alias("equal_after_recovery")
    )


#: Of a dictionary payload as _payloads writes it.
_PAYLOAD = "features array<struct<token: string, description: string>>, categories array<struct<name: string>>, columns array<struct<name: string>>"


def _payloads(parts, rows=10_000):
    """Dictionary payloads: one of each brand's category, and the features in payloads of two thirds of ``rows`` on average, whatever the brands."""
    n = max(1, -(-3 * parts.count() // (2 * rows)))
    # a number of partitions of its own: tasks grow with the payloads and are not merged by bytes
    dealt = parts.withColumn("piece", F.pmod(F.xxhash64("token"), F.lit(n))).repartition(-(-n // 4), "piece")
    features = dealt.groupBy("piece").agg(F.collect_list(F.struct("token", F.col("p_name").alias("description"))).alias("features"))
    brands = parts.select("p_brand").distinct().select(F.array(F.struct(F.col("p_brand").alias("name"))).alias("categories"), F.array(F.struct(F.lit("token").alias("name"))).alias("columns"))
    return features.select("features").unionByName(brands, allowMissingColumns=True)


def load_dictionary(spark, sf_dir):
    path, mapping = scratch(spark), scratch(spark)
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("Part_"), F.col("p_partkey").cast("string")).alias("token"), "p_name", "p_type", "p_brand")
    _payloads(parts).write.option("maxRecordsPerFile", 1).json(path)
    parts.select("token", F.concat(F.lit("feat_"), F.substring_index("token", "_", -1)).alias("column_name")).write.option("header", "true").csv(mapping)
    return copies.load_dictionary(spark, mapping, path, {"dataset": "parts", "version": "1"}, _PAYLOAD, "token string, column_name string")["features"]


def load_log_table(spark, sf_dir):
    path = scratch(spark)
    copies.replace_table(log_lines(table(spark, sf_dir, "events")), path)
    return copies.copy_report(log_lines(table(spark, sf_dir, "events")), spark.read.parquet(path), "log")


def scored_output(spark, sf_dir):
    path = scratch(spark)
    copies.write_once(device_events(table(spark, sf_dir, "events")).select("event_id", (F.col("bytes_sent") % 100 / 100.0).alias("score")), path)
    return spark.read.parquet(path)


QUERIES = {f.__name__: f for f in [
    file_manifest, ingest_provenance, limit_per_file, max_files, hub_rows_stream, pinned_scan, audit_scan, delete_aware_scan, schema_evolution_scan, snapshot_scan, drop_loader_columns, log_scan, predict_scan,
    replace_table, grouped_replace_append, chunked_copy, copy_verify, key_inventory, foreign_keys, missing_keys, missing_ranges, key_range_filter, recover_rows, keys_equal, load_dictionary, load_log_table, scored_output,
]}

SQL = {
    "snapshot_scan": "SELECT 1 AS snapshot, c_custkey, c_acctbal, NULL AS c_mktsegment FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT 2, c_custkey, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END FROM customer",
    "ingest_provenance": "SELECT 'shop' AS dataset_id, 'wide' AS config_name, 'train' AS split_name, row_number() OVER () - 1 AS row_number, 'orders.parquet' AS source_file, o_orderkey FROM orders",
    "limit_per_file": f"WITH {_EV} SELECT source_file, row_number, event_id FROM ev WHERE row_number < 100",
    "max_files": f"WITH {_EV} SELECT source_file, count(*) AS n_rows FROM ev GROUP BY 1",
    "hub_rows_stream": f"WITH {SAMPLES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY config_name, split_name ORDER BY hash) AS k FROM samples WHERE split_name = 'train') SELECT config_name, split_name, hash FROM r WHERE k <= 25",
    "pinned_scan": f"WITH {SAMPLES_SQL} SELECT hash, label, feat_0 FROM samples WHERE dataset_id = 'orders' AND config_name = 'wide'",
    "audit_scan": f"WITH {SAMPLES_SQL} SELECT * EXCLUDE (source_file, row_number) FROM samples WHERE dataset_id = 'orders' AND config_name = 'narrow'",
    "delete_aware_scan": f"WITH {_EV} SELECT event_id, row_number FROM ev WHERE event_id % 13 <> 0 AND event_type = 'click'",
    "schema_evolution_scan": "SELECT c_custkey, c_acctbal, 'unknown' AS c_region FROM customer",
    "drop_loader_columns": "SELECT * FROM supplier",
    "predict_scan": f"WITH {SAMPLES_SQL} SELECT feat_0, feat_1, feat_2, config_name, dataset_id, hash FROM samples",
    "replace_table": "SELECT * FROM nation",
    "grouped_replace_append": "SELECT * FROM orders",
    "chunked_copy": "SELECT * FROM part",
    "copy_verify": "WITH n AS (SELECT count(*) AS a, count(*) FILTER (l_orderkey % 11 <> 0) AS b FROM lineitem) SELECT 'lineitem' AS table_name, a AS source_rows, a AS copied_rows, true AS verified FROM n UNION ALL SELECT 'lineitem_short', a, b, a = b FROM n",
    "key_inventory": "SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null' ELSE 'duplicate' END AS problem FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL",
    "foreign_keys": f"WITH {_LINES} SELECT source_file, -row_number - 1 AS row_number FROM src WHERE row_number % 50 = 0",
    "missing_keys": f"WITH {_LINES} SELECT source_file, row_number FROM src EXCEPT SELECT source_file, row_number FROM dst",
    "missing_ranges": f"""WITH {_LINES}, gone AS (SELECT * FROM src EXCEPT SELECT * FROM dst WHERE (row_number // 40) % 3 <> 0),
i AS (SELECT *, row_number - row_number() OVER (PARTITION BY source_file ORDER BY row_number) AS island FROM gone)
SELECT source_file, min(row_number) AS first_row, max(row_number) AS last_row, count(*) AS n_rows FROM i GROUP BY source_file, island""",
    "key_range_filter": f"WITH {_LINES} SELECT source_file, row_number FROM src WHERE row_number % 11 = 0",
    "recover_rows": f"WITH {_LINES} SELECT source_file, row_number FROM src",
    "keys_equal": f"""WITH {_LINES}, b AS (SELECT * FROM dst UNION ALL SELECT * FROM dst WHERE row_number % 50 = 0 UNION ALL SELECT -row_number - 1, source_file FROM dst WHERE row_number % 50 = 0),
k AS (SELECT coalesce(s.source_file, c.source_file) AS source_file, coalesce(s.n, 0) AS s, coalesce(c.n, 0) AS c FROM (SELECT row_number, source_file, count(*) AS n FROM src GROUP BY 1, 2) s FULL JOIN (SELECT row_number, source_file, count(*) AS n FROM b GROUP BY 1, 2) c ON s.row_number = c.row_number AND s.source_file = c.source_file)
SELECT source_file, count(*) FILTER (c = 0) AS missing, count(*) FILTER (s = 0) AS "foreign", count(*) FILTER (s > 0 AND c > s) AS repeated, true AS equal_after_recovery FROM k WHERE c <> s GROUP BY 1""",
    "file_manifest": "SELECT table_name || '.parquet' AS file_name, CAST(NULL AS VARCHAR) AS split_name, true AS holds_bytes FROM information_schema.tables WHERE table_schema = 'main'",
    "log_scan": f"WITH {LOG_SQL} SELECT count(*) AS n_lines, count(*) AS n_places, count(*) FILTER (starts_with(raw_line, 'unparsed')) AS unparsed, CAST(sum(length(raw_line)) AS BIGINT) AS n_chars FROM lines",
    "load_log_table": "SELECT 'log' AS table_name, count(*) AS source_rows, count(*) AS copied_rows, true AS verified FROM events",
    "load_dictionary": "SELECT 'Part_' || CAST(p_partkey AS VARCHAR) AS token, 'feat_' || CAST(p_partkey AS VARCHAR) AS column_name, p_name AS description, 'parts' AS dataset, '1' AS version FROM part",
    "scored_output": "SELECT event_id, (CAST(round(value * 100) AS BIGINT) % 100) / 100.0::DOUBLE AS score FROM events",
}
