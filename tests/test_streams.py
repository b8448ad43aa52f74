"""Stateful streams: trailing sums against brute force over batches out of order, state and timers; late data by day."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from broadloom.streaming import events as S

HOUR = 3600 * 1_000_000
T0 = 1_700_000_000


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    S.rocksdb_state(spark)
    yield
    spark.conf.set(name, before)


def stream_of(spark, path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/{k}")
        for name in os.listdir(f"{path}/in/{k}"):  # batches are read by age
            os.utime(f"{path}/in/{k}/{name}", (T0 + 100 * k,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")


def test_trailing_sums_over_batches_equal_brute_force(spark, tmp_path, rocksdb):
    rng = random.Random(6)
    rows = [(d, 1000 * d + k, T0 + rng.randrange(6 * 3600), rng.randrange(-5, 50)) for d in range(3) for k in range(60)]
    rng.shuffle(rows)
    batches = [rows[i : i + 45] + rows[:3] for i in range(0, len(rows), 45)]  # three events come again and again
    stream = stream_of(spark, tmp_path, batches, "device_id long, event_id long, s long, value long").withColumn("event_time", F.timestamp_seconds("s"))
    got = {r.event_id: r.total for r in S.drain(S.trailing_stream(stream, HOUR, 24 * HOUR), "update", ["device_id", "event_id"]).collect()}
    want = {i: sum(v for e, _, s, v in rows if e == d and t - 3600 <= s < t) for d, i, t, _ in rows}
    assert got == want


def test_state_follows_new_events_and_timers_empty_it(spark, tmp_path, rocksdb):
    # a long history of one device, then one event at a time, then silence while another device moves the watermark
    history = [(1, k, T0 + 60 * k, 1) for k in range(600)]
    batches = [history, [(1, 1000, T0 + 60 * 600, 1)], [(2, 2000, T0 + 60 * 601, 1)], [(2, 2001, T0 + 100 * 3600, 1)], [(2, 2002, T0 + 100 * 3600 + 1, 1)], [(2, 2003, T0 + 100 * 3600 + 2, 1)]]
    stream = stream_of(spark, tmp_path, batches, "device_id long, event_id long, s long, value long").withColumn("event_time", F.timestamp_seconds("s"))
    query = S.trailing_stream(stream, HOUR, HOUR).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).foreachBatch(lambda df, n: df.count()).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows]
    updated = [p.stateOperators[0].numRowsUpdated for p in progress]
    total = [p.stateOperators[0].numRowsTotal for p in progress]
    # a new event writes its own cell and its timer, not the device's history
    assert updated[0] >= 40 and updated[1] <= 4 and updated[2] <= 4
    assert total[-1] < total[0] / 4, total


def test_sparse_history_takes_few_entries_and_one_timer(spark, tmp_path, rocksdb):
    # 60 events in cells of their own, then events among them, then another device's that moves the watermark past all but the last
    history = [(1, k, T0 + 5400 * k, k + 1) for k in range(60)]
    more = [(1, 1000 + k, T0 + 5400 * k + 600 * (k % 9), 7) for k in range(0, 60, 4)]
    batches = [history, more, [(2, 2000, T0 + 5400 * 60, 1)], [(2, 2001, T0 + 5400 * 60 + 1, 1)], [(2, 2002, T0 + 5400 * 60 + 2, 1)]]
    stream = stream_of(spark, tmp_path, batches, "device_id long, event_id long, s long, value long").withColumn("event_time", F.timestamp_seconds("s"))
    got = {}
    query = S.trailing_stream(stream, HOUR, 100 * HOUR).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
    query = query.foreachBatch(lambda df, n: got.update({r.event_id: r.total for r in df.collect()})).start()
    query.awaitTermination()
    rows = [r for b in batches for r in b]
    assert got == {i: sum(v for e, _, s, v in rows if e == d and t - 3600 <= s < t) for d, i, t, _ in rows}
    assert [p for p in query.recentProgress if p.numInputRows][0].stateOperators[0].numRowsUpdated < 20


def late_table(spark, tmp_path, batches):
    schema = "event_id long, device_id long, event_time timestamp, arrival timestamp, value long"
    made = [[(i, d, t, a, v) for i, d, t, a, v in rows] for rows in batches]
    for k, rows in enumerate(made):
        df = spark.createDataFrame(rows, "event_id long, device_id long, t long, a long, value long").select("event_id", "device_id", F.timestamp_seconds("t").alias("event_time"), F.timestamp_seconds("a").alias("arrival"), "value")
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        for name in os.listdir(f"{tmp_path}/in/{k}"):
            os.utime(f"{tmp_path}/in/{k}/{name}", (T0 + 100 * k,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    return stream, S.LateData(f"{tmp_path}/out", "device_id", "event_time", "value", 6 * HOUR, 24 * HOUR)


def test_late_data_remakes_touched_days_only(spark, tmp_path):
    day = 86_400
    start = T0 // day * day
    rng = random.Random(3)
    first = [(k, k % 2, start + rng.randrange(8 * day), start + 8 * day, k) for k in range(200)]
    on_time = [(300, 0, start + 8 * day + 60, start + 8 * day + 60, 5)]
    late = [(400, 1, start + 2 * day + 23 * 3600, start + 8 * day + 7200, 1000)]  # reaches into day 3
    stream, table = late_table(spark, tmp_path, [first, on_time, late])
    written = {}

    def newest(batch):
        written[len(written)] = {d: sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{table.sums}/_day=*")}
        return S.with_newest(batch, "event_time", "arrival")

    S.late_data_stream(stream, table, newest)
    after = {d: sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{table.sums}/_day=*")}
    changed = sorted(os.path.basename(d)[5:] for d in after if written[2].get(d) != after[d])
    days = [str(r[0]) for r in spark.range(1).select(F.explode(F.array(*[F.to_date(F.timestamp_seconds(F.lit(start + k * day))) for k in (2, 3)]))).collect()]
    assert changed == days
    assert [r.event_id for r in spark.read.parquet(f"{table.late}/*").collect()] == [400]
    rows = first + on_time + late
    want = {i: sum(v for _, e, s, _, v in rows if e == d and t - 6 * 3600 <= s < t) for i, d, t, _, _ in rows}
    assert {r.event_id: r.total for r in spark.read.parquet(table.sums).collect()} == want
    # the plan of a recomputation reads the touched days and the one that their windows reach back into
    plan = S.recompute_days(spark, table, days[:1], "event_id long, device_id long, event_time timestamp, arrival timestamp, value long")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "_day#" in text.split("PartitionFilters: [")[1].split("]")[0] and plan.count() > 0


def test_late_data_of_an_empty_stream(spark, tmp_path):
    stream, table = late_table(spark, tmp_path, [[(1, 1, T0, T0, 5)]])
    S.late_data_stream(stream.filter("event_id < 0"), table, lambda b: S.with_newest(b, "event_time", "arrival"))
    assert not glob.glob(f"{table.sums}/_day=*")
