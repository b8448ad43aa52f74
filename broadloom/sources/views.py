"""Feature-table views over the star schema, and their SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.session import table

FEATURES = ["feat_0", "feat_1", "feat_2"]

SAMPLES_SQL = """samples AS (
  SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS hash,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS label,
         strftime(o_orderdate, '%Y-%m') AS year_month,
         CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split_name,
         CASE WHEN o_orderkey % 7 = 0 THEN 'narrow' ELSE 'wide' END AS config_name,
         'orders' AS dataset_id, o_orderpriority AS family,
         COUNT(l_orderkey) AS vt_count,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS feat_0,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS feat_1,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS feat_2,
         'orders' || CAST(o_orderkey % 4 AS VARCHAR) AS source_file, o_orderkey // 4 AS row_number
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, o_orderstatus, o_orderdate, o_orderpriority)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order as a labelled sample with counted features; lines are summed before the join."""
    key = F.col("o_orderkey")
    is_ = lambda name, value: F.sum(F.when(F.col(name) == value, 1).otherwise(0))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), is_("l_returnflag", "R").alias("f0"), is_("l_returnflag", "A").alias("f1"), is_("l_linestatus", "O").alias("f2"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long"))
    return table(spark, sf_dir, "orders").join(lines, key == F.col("l_orderkey"), "left").select(
        F.sha2(key.cast("string"), 256).alias("hash"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.when(key % 5 == 0, "test").otherwise("train").alias("split_name"),
        F.when(key % 7 == 0, "narrow").otherwise("wide").alias("config_name"),
        F.lit("orders").alias("dataset_id"),
        F.col("o_orderpriority").alias("family"),
        zero("n").alias("vt_count"),
        zero("f0").alias("feat_0"),
        zero("f1").alias("feat_1"),
        zero("f2").alias("feat_2"),
        F.concat(F.lit("orders"), (key % 4).cast("string")).alias("source_file"),
        F.floor(key / 4).cast("long").alias("row_number"),
    )


EVENTS_SQL = """device_events AS (
  SELECT event_id, user_id AS device_id, ts AS event_time, ts + to_minutes(CAST(event_id % 7 AS INTEGER)) AS ingestion_time,
         event_type, CAST(round(value * 100) AS BIGINT) AS bytes_sent
  FROM events)"""


def device_events(events: DataFrame) -> DataFrame:
    """Events as a device stream with event time and availability time; bytes are whole numbers."""
    return events.select(
        "event_id",
        F.col("user_id").alias("device_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int"))).alias("ingestion_time"),
        "event_type",
        F.round(F.col("value") * 100).cast("long").alias("bytes_sent"),
    )


SCORES_SQL = """scores AS (
  SELECT event_id AS id, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS label,
         (event_id * 7919 % 1000) / 1000.0::DOUBLE AS score, strftime(ts, '%Y') AS year
  FROM events)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled scores in [0, 1) with many ties."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        ((F.col("event_id") * 7919 % 1000) / F.lit(1000.0)).alias("score"),
        F.date_format("ts", "yyyy").alias("year"),
    )


LOG_SQL = """lines AS (
  SELECT event_id AS line_number,
         CASE WHEN event_id % 11 = 0 THEN 'unparsed ' || event_type
              ELSE strftime(ts, '%m-%d %H:%M:%S') || '.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '  ' || CAST(user_id AS VARCHAR) || ' ' || CAST(event_id AS VARCHAR)
                   || CASE WHEN event_id % 2 = 0 THEN ' I ' ELSE ' E ' END || CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type || ' : ' END || 'value ' || CAST(event_id % 97 AS VARCHAR) END AS raw_line
  FROM events)"""


def log_lines(events: DataFrame) -> DataFrame:
    """(line_number, raw_line): events in the Android log grammar; some without component, some unparsable."""
    i = F.col("event_id")
    good = F.concat(
        F.date_format("ts", "MM-dd HH:mm:ss"), F.lit("."), F.lpad((i % 1000).cast("string"), 3, "0"), F.lit("  "), F.col("user_id").cast("string"), F.lit(" "), i.cast("string"),
        F.when(i % 2 == 0, " I ").otherwise(" E "), F.when(i % 3 == 0, "").otherwise(F.concat(F.col("event_type"), F.lit(" : "))), F.lit("value "), (i % 97).cast("string"),
    )
    return events.select(i.alias("line_number"), F.when(i % 11 == 0, F.concat(F.lit("unparsed "), F.col("event_type"))).otherwise(good).alias("raw_line"))
