"""Windows, point-in-time joins and streams over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.operators import windows as W
from broadloom.queries.texts import SQL as _TEXT
from broadloom.session import scratch, table
from broadloom.sources.views import EVENTS_SQL, device_events, log_lines
from broadloom.streaming import events as S

DAY = 24 * 3600
WIDTH_US = 6 * 3600 * 1_000_000


def _events(spark, sf_dir):
    return device_events(table(spark, sf_dir, "events"))


def trailing_window(spark, sf_dir):
    """All four closed sides, from one split of the time line."""
    rows = _events(spark, sf_dir).select("event_id", "device_id", "event_time", "bytes_sent")
    return W.trailing_sums_split(rows, "device_id", "event_time", "bytes_sent", WIDTH_US, {f"total_{c}": c for c in W.CLOSED}).drop("bytes_sent", "event_time")


def tumbling_window(spark, sf_dir):
    return W.tumbling(_events(spark, sf_dir), "device_id", "event_time", "bytes_sent", "1 hour")


def tumbling_window_right(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("event_time", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))
    return W.tumbling(rows, "device_id", "event_time", "bytes_sent", "1 hour", "right")


def sliding_window(spark, sf_dir):
    return W.sliding(_events(spark, sf_dir), "device_id", "event_time", "bytes_sent", "2 hours", "1 hour")


def asof_features(spark, sf_dir):
    """Clicks with the newest purchase of the device that was available then."""
    rows = _events(spark, sf_dir)
    points = rows.filter("event_type = 'click'").select("event_id", "device_id", F.col("event_time").alias("at"))
    bought = rows.filter("event_type = 'purchase'").select("device_id", (F.col("ingestion_time") + F.expr("INTERVAL 5 MINUTES")).alias("available"), F.col("bytes_sent").alias("spent"))
    bought = bought.groupBy("device_id", "available").agg(F.max("spent").alias("spent"))
    return W.asof_join(points, bought, "device_id", "at", "available", ["spent"])


def stream_log_parse(spark, sf_dir):
    path = scratch(spark)
    log_lines(table(spark, sf_dir, "events")).write.parquet(path)
    return S.drain(S.parse_log_stream(spark.readStream.schema("line_number long, raw_line string").parquet(path)), "append")


def _stream(spark, sf_dir):
    return device_events(S.file_stream(spark, f"{sf_dir}/events.parquet")).withColumn("event_time", F.col("event_time").cast("timestamp"))


def _ntz(df):
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_tumbling(spark, sf_dir):
    return _ntz(S.drain(S.tumbling_stream(_stream(spark, sf_dir), "device_id", "event_time", "bytes_sent", "1 hour", "40 days"), "update", ["device_id", "window_start"]))


def stream_sliding(spark, sf_dir):
    return _ntz(S.drain(S.sliding_stream(_stream(spark, sf_dir), "device_id", "event_time", "bytes_sent", "2 hours", "1 hour", "40 days"), "update", ["device_id", "window_start"]))


def stream_trailing(spark, sf_dir):
    S.rocksdb_state(spark)
    rows = _stream(spark, sf_dir).select("device_id", "event_id", "event_time", F.col("bytes_sent").alias("value"))
    return S.drain(S.trailing_stream(rows, WIDTH_US, 3600 * 1_000_000), "update", ["device_id", "event_id"])


def stream_dedup(spark, sf_dir):
    rows = _stream(spark, sf_dir)
    return S.drain(S.dedup_stream(rows.unionByName(rows), ["event_id"], "event_time", "40 days").select("event_id", "device_id"), "append")


def _arriving(spark, sf_dir):
    """Events of which every 17th arrives two days late."""
    return _events(spark, sf_dir).withColumn("arrival", F.when(F.col("event_id") % 17 == 0, F.col("event_time") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("event_time")))


def late_data_stream(spark, sf_dir):
    """A stream of three loads by arrival: late events set aside, trailing sums of touched days made anew; all sums, and which events were late."""
    rows = _arriving(spark, sf_dir).select("event_id", "device_id", "event_time", "arrival", "bytes_sent")
    first, last = rows.agg(F.min("arrival"), F.max("arrival")).first()
    cuts = [None, *[(first + (last - first) * k / 3).replace(minute=0, second=0, microsecond=0) for k in (1, 2)], None]
    source = scratch(spark)
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        part = rows if low is None else rows.filter(F.col("arrival") >= low)
        (part if high is None else part.filter(F.col("arrival") < high)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = S.LateData(scratch(spark), "device_id", "event_time", "bytes_sent", WIDTH_US, DAY * 1_000_000)
    S.late_data_stream(stream, out, lambda batch: S.with_newest(batch, "event_time", "arrival"))
    late = spark.read.schema(rows.schema).parquet(f"{out.late}/*").select("event_id").withColumn("late", F.lit(True))
    sums = spark.read.schema("event_id long, device_id long, total long").parquet(out.sums)
    return sums.join(late, "event_id", "left").select("event_id", "device_id", "total", F.coalesce("late", F.lit(False)).alias("late"))


def late_data_recompute(spark, sf_dir):
    """Trailing sums anew for the rows that late events touch."""
    rows = _arriving(spark, sf_dir)
    late = S.late_rows(rows, "event_time", "arrival", DAY)
    touched = S.affected(rows, late, "device_id", "event_time", WIDTH_US // 1_000_000).select("event_id")
    sums = W.trailing_sum_split(rows, "device_id", "event_time", "bytes_sent", WIDTH_US)
    return sums.join(touched, "event_id", "left_semi").select("event_id", "device_id", "total")


QUERIES = {f.__name__: f for f in [trailing_window, tumbling_window, tumbling_window_right, sliding_window, asof_features, stream_log_parse, stream_tumbling, stream_sliding, stream_trailing, stream_dedup, late_data_stream, late_data_recompute]}


def _trail(lo: str, hi: str) -> str:
    return f"CAST(coalesce(sum(bytes_sent) OVER (PARTITION BY device_id ORDER BY epoch_us(event_time) RANGE BETWEEN {lo} AND {hi}), 0) AS BIGINT)"


_SIDES = {"left": (f"{WIDTH_US} PRECEDING", "1 PRECEDING"), "right": (f"{WIDTH_US - 1} PRECEDING", "CURRENT ROW"), "both": (f"{WIDTH_US} PRECEDING", "CURRENT ROW"), "neither": (f"{WIDTH_US - 1} PRECEDING", "1 PRECEDING")}
_TUMBLING = f"WITH {EVENTS_SQL} SELECT device_id, date_trunc('hour', event_time) AS window_start, CAST(sum(bytes_sent) AS BIGINT) AS total, count(*) AS n FROM device_events GROUP BY 1, 2"
_SLIDING = f"WITH {EVENTS_SQL}, s AS (SELECT *, unnest([date_trunc('hour', event_time), date_trunc('hour', event_time) - INTERVAL 1 HOUR]) AS window_start FROM device_events) SELECT device_id, window_start, CAST(sum(bytes_sent) AS BIGINT) AS total, count(*) AS n FROM s GROUP BY 1, 2"
_LATE = f"""WITH {EVENTS_SQL}, r AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN event_time + INTERVAL 2 DAYS ELSE event_time END AS arrival FROM device_events),
h AS (SELECT date_trunc('hour', arrival) AS hour, max(event_time) AS m FROM r GROUP BY 1), t AS (SELECT hour, max(m) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM h),
late AS (SELECT r.* FROM r JOIN t ON date_trunc('hour', r.arrival) = t.hour WHERE r.event_time < t.top - INTERVAL 1 DAY),
s AS (SELECT event_id, device_id, event_time, {_trail(*_SIDES['left'])} AS total FROM r)
"""
SQL = {
    "trailing_window": f"WITH {EVENTS_SQL} SELECT event_id, device_id, " + ", ".join(f"{_trail(*b)} AS total_{c}" for c, b in _SIDES.items()) + " FROM device_events",
    "tumbling_window": _TUMBLING,
    "tumbling_window_right": f"WITH {EVENTS_SQL} SELECT device_id, date_trunc('hour', event_time) - INTERVAL 1 HOUR AS window_start, CAST(sum(bytes_sent) AS BIGINT) AS total, count(*) AS n FROM device_events GROUP BY 1, 2",
    "sliding_window": _SLIDING,
    "asof_features": f"WITH {EVENTS_SQL}, f AS (SELECT device_id, ingestion_time + INTERVAL 5 MINUTES AS available, max(bytes_sent) AS spent FROM device_events WHERE event_type = 'purchase' GROUP BY 1, 2), p AS (SELECT event_id, device_id, event_time AS at FROM device_events WHERE event_type = 'click') SELECT p.event_id, p.device_id, p.at, f.spent FROM p ASOF LEFT JOIN f ON p.device_id = f.device_id AND p.at >= f.available",
    "stream_log_parse": _TEXT["parse_android_log"],
    "stream_tumbling": _TUMBLING,
    "stream_sliding": _SLIDING,
    "stream_trailing": f"WITH {EVENTS_SQL} SELECT device_id, event_id, {_trail(*_SIDES['left'])} AS total FROM device_events",
    "stream_dedup": "SELECT event_id, user_id AS device_id FROM events",
    "late_data_stream": _LATE + "SELECT event_id, device_id, total, event_id IN (SELECT event_id FROM late) AS late FROM s",
    "late_data_recompute": f"""{_LATE}SELECT event_id, device_id, total FROM s WHERE EXISTS (SELECT 1 FROM late l WHERE l.device_id = s.device_id AND s.event_time > l.event_time AND s.event_time <= l.event_time + INTERVAL {WIDTH_US // 1_000_000} SECOND)""",
}
