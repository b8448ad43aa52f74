"""Structured Streaming forms of the log parser, windows, identity repeats and late data."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from broadloom.functions.text import parse_log
from broadloom.operators.windows import trailing_sums_split
from broadloom.session import scratch


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A Parquet path (file or folder) as a stream, with the schema that is there now."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path + "*")


def drain(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns its rows; in update mode the last version of each key.

    Batches go to a Parquet table by batch number, so a repeated batch replaces itself.
    """
    spark, path = stream.sparkSession, scratch(stream.sparkSession)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/_batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    try:
        rows = spark.read.schema(f"{stream.schema.simpleString()[7:-1].replace(':', ' ')}, _batch long").parquet(f"{path}/out")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], stream.schema)
    if keys is None:
        return rows.drop("_batch")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "_batch").alias("x")).select("x.*")


def parse_log_stream(lines: DataFrame) -> DataFrame:
    """The batch parser on a stream; stateless."""
    return parse_log(lines)


def tumbling_stream(events: DataFrame, key: str, ts: str, value: str, width: str, delay: str) -> DataFrame:
    """Tumbling sums with a watermark."""
    w = F.window(ts, width)
    return events.withWatermark(ts, delay).groupBy(key, w.alias("w")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "total", "n")


def sliding_stream(events: DataFrame, key: str, ts: str, value: str, width: str, slide: str, delay: str) -> DataFrame:
    """Sliding sums with a watermark."""
    w = F.window(ts, width, slide)
    return events.withWatermark(ts, delay).groupBy(key, w.alias("w")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "total", "n")


def dedup_stream(events: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """The first row of each identity inside the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def _sums(at: np.ndarray, value: np.ndarray, width_us: int) -> np.ndarray:
    """Per place of rising times the sum of values over [t - width, t)."""
    running = np.append(0, np.cumsum(value))
    return running[np.searchsorted(at, at, side="left")] - running[np.searchsorted(at, at - width_us, side="left")]


#: Cells of a trailing window's width that a device's state is cut into.
CELLS = 4
#: Events up to which neighbouring cells that come in one batch are kept as one entry.
PACKED = 12


class TrailingSums(StatefulProcessor):
    """Events of one device by cells of time; a batch reads and writes the cells around its events only.

    An entry of the state is a cell of time, or a run of cells that hold few events
    together: a call to the state costs more than the sums. A device with entries has
    one timer, for the first that could go when the timer was set. It drops the
    entries whose events the watermark has passed for good and is set anew for what is
    left, so an idle device ends with no state.
    """

    def __init__(self, width_us: int):
        self.width, self.cell = width_us, max(width_us // CELLS, 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "first long, last long", "at array<long>, id array<long>, value array<long>")

    def _expiry(self, entry: tuple[int, int]) -> int:
        """After the last microsecond that a window over this entry can start before, in milliseconds."""
        return ((entry[1] + 1) * self.cell + self.width) // 1000 + 1

    def _around(self, own: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """The entries that windows of, or over, events in these cells can touch."""
        near = np.unique(np.unique(own)[:, None] + np.arange(-CELLS - 1, CELLS + 2))
        keys = [(int(first), int(last)) for first, last in self.cells.keys()]
        touched = [k for k in keys if np.searchsorted(near, k[0]) < np.searchsorted(near, k[1], side="right")]
        return {k: np.array(self.cells.getValue(k), np.int64).T for k in touched}

    def _deal(self, new: np.ndarray, held: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], list[np.ndarray]]:
        """New events, in order of time, by the entry that they go to: one that is there, or runs of cells that no entry covers."""
        own, starts = np.unique(new[:, 0] // self.cell, return_index=True)
        out: dict[tuple[int, int], list[np.ndarray]] = {}
        run: list[np.ndarray] = []
        first = last = 0
        for c, part in zip(own.tolist(), np.split(new, starts[1:]), strict=True):
            over = [k for k in held if k[0] <= c <= k[1]] if held else []
            if over:
                entry = next((k for k in over if k == (c, c) or len(held[k]) < 4 * PACKED), (c, c))
                out.setdefault((c, c) if (c, c) in over else entry, []).append(part)
                continue
            if run and sum(map(len, run)) >= PACKED:
                out[first, last] = run
                run = []
            if not run:
                first = c
            run, last = [*run, part], c
        if run:
            out[first, last] = run
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = np.concatenate([np.empty((0, 3), np.int64), *(np.column_stack([b[c].to_numpy(np.int64) for c in ("at", "event_id", "value")]) for b in rows)])
        new = new[np.unique(new[:, 1], return_index=True)[1]]  # a repeated event counts once
        some = self.cells.exists()  # a new device has nothing to look up
        held = self._around(new[:, 0] // self.cell) if some else {}
        if held:
            new = new[~np.isin(new[:, 1], np.concatenate([h[:, 1] for h in held.values()]))]
        if not len(new):
            return
        new = new[np.argsort(new[:, 0], kind="stable")]
        dealt = self._deal(new, held)
        if not some:
            self.handle.registerTimer(min(map(self._expiry, dealt)))
        for entry, parts in dealt.items():
            held[entry] = np.concatenate([held[entry], *parts] if entry in held else parts)
            self.cells.updateValue(entry, tuple(held[entry].T.tolist()))
        # what is sent lies in a window's reach of a new event, and all entries there are held
        rows_ = np.concatenate(list(held.values()))
        rows_ = rows_[np.lexsort((rows_[:, 1], rows_[:, 0]))]
        total = _sums(rows_[:, 0], rows_[:, 2], self.width)
        # an event's sum is new if the event is, or if a new one stands in its window
        times = new[:, 0]
        behind = np.searchsorted(times, rows_[:, 0], "left") > np.searchsorted(times, rows_[:, 0] - self.width, "left")
        sent = behind | np.isin(rows_[:, 1], new[:, 1])
        yield pd.DataFrame({"device_id": np.full(sent.sum(), key[0], np.int64), "event_id": rows_[sent, 1], "total": total[sent]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        entries = [(int(first), int(last)) for first, last in self.cells.keys()]
        left = [e for e in entries if self._expiry(e) > passed]
        if len(left) <= 2 < len(entries):  # fewer calls than by removing each
            kept = [(e, self.cells.getValue(e)) for e in left]
            self.cells.clear()
            for e, held in kept:
                self.cells.updateValue(e, held)
        else:
            for e in set(entries).difference(left):
                self.cells.removeKey(e)
        if left:
            self.handle.registerTimer(min(map(self._expiry, left)))
        return iter(())

    def close(self) -> None:
        pass


def rocksdb_state(spark: SparkSession) -> None:
    """Keeps the state of streams in RocksDB with changelogs, as map state and timers need; set by the caller's session for all its streams."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def trailing_stream(events: DataFrame, width_us: int, delay_us: int) -> DataFrame:
    """(device_id, event_id, total): sums over [t - width, t) per device, in update mode.

    ``events`` has device_id, event_id, event_time (timestamp) and value (whole numbers);
    the session keeps its state in RocksDB (rocksdb_state). An event that arrives out
    of order corrects the sums after it, which are sent again. The watermark lags by
    ``delay``: events behind it are left out (late_data_stream sets them aside).
    """
    rows = events.withWatermark("event_time", f"{delay_us // 1000} milliseconds").select("device_id", "event_id", "event_time", F.unix_micros("event_time").alias("at"), "value")
    return rows.groupBy("device_id").transformWithStateInPandas(TrailingSums(width_us), "device_id long, event_id long, total long", "Update", "EventTime")


@dataclass(frozen=True)
class LateData:
    """Folders of a stream of events: all of them by day, those that came too late, and the trailing sums by day."""

    path: str
    key: str
    ts: str
    value: str
    width_us: int
    delay_us: int

    @property
    def events(self) -> str:
        return f"{self.path}/events"

    @property
    def late(self) -> str:
        return f"{self.path}/late"

    @property
    def sums(self) -> str:
        return f"{self.path}/sums"


def _days(df: DataFrame) -> list[str]:
    """The days of some rows; there are as many as days that a batch touches."""
    return sorted(str(r[0]) for r in df.select("_day").distinct().collect())


def _read_days(spark: SparkSession, path: str, schema: str, days: list[str] | None = None) -> DataFrame:
    """Rows of a table by day, whose other days' files are not listed in the plan."""
    df = spark.read.schema(f"{schema}, _day date").option("basePath", path).parquet(path)
    return df if days is None else df.filter(F.col("_day").isin([datetime.date.fromisoformat(d) for d in days]))


def recompute_days(spark: SparkSession, table: LateData, days: list[str], schema: str) -> DataFrame:
    """Trailing sums of all events of these days; reads them and as many days before as a window reaches."""
    span = -(-table.width_us // 86_400_000_000)
    wanted = [datetime.date.fromisoformat(d) for d in days]
    needed = sorted({str(d - datetime.timedelta(days=k)) for d in wanted for k in range(span + 1)})
    rows = _read_days(spark, table.events, schema, needed).drop("_batch")
    return trailing_sums_split(rows, table.key, table.ts, table.value, table.width_us, {"total": "left"}).filter(F.col("_day").isin(wanted))


def late_data_stream(events: DataFrame, table: LateData, newest: Callable[[DataFrame], DataFrame]) -> None:
    """Runs a stream of events over what is there: rows behind the watermark go to a side table, and sums of touched days are made anew.

    ``newest`` gives a batch's rows with a column _top, the newest event time before
    each row's arrival within the batch (null where there is none); the newest time of
    earlier batches is kept beside the tables. A row is late if it is older than that
    by more than ``delay``. Each batch writes its events under its own number, so a
    repeated batch replaces itself, then overwrites the sums of the days whose windows
    its rows reach into, late or not. Other days are neither read nor written.
    """
    spark = events.sparkSession
    schema = ", ".join(f"`{n}` {t}" for n, t in events.dtypes)
    day = F.to_date(F.col(table.ts))

    def put(batch: DataFrame, number: int) -> None:
        tops = spark.read.schema("top timestamp, _batch long").parquet(f"{table.path}/top").filter(F.col("_batch") < number) if number else spark.createDataFrame([], "top timestamp, _batch long")
        before = tops.agg(F.max("top").alias("before"))  # one row
        rows = newest(batch).crossJoin(F.broadcast(before)).withColumn("_top", F.greatest("_top", F.col("before").cast(dict(batch.dtypes)[table.ts])))
        late = rows.filter(F.col(table.ts) < F.col("_top") - F.make_dt_interval(secs=F.lit(table.delay_us / 1_000_000)))
        batch.agg(F.max(table.ts).cast("timestamp").alias("top")).write.mode("overwrite").parquet(f"{table.path}/top/_batch={number}")
        late.select(*batch.columns).write.mode("overwrite").parquet(f"{table.late}/_batch={number}")
        by_day = batch.withColumn("_day", day)
        by_day.withColumn("_batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "_batch").parquet(table.events)
        reach = by_day.select("_day").unionByName(batch.select(F.to_date(F.col(table.ts) + F.expr(f"INTERVAL {table.width_us} MICROSECOND")).alias("_day"))).distinct()
        days = _days(reach)
        if days:
            recompute_days(spark, table, days, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(table.sums)

    query = events.writeStream.option("checkpointLocation", f"{table.path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()


def with_newest(events: DataFrame, ts: str, arrival: str) -> DataFrame:
    """Adds _top, the newest event time of the hours of arrival before the row's, null in the first hour.

    The newest time is taken per hour of arrival and carried forward over hours, so
    the running maximum covers as many rows as there are hours.
    """
    from pyspark.sql import Window

    hour = F.date_trunc("hour", F.col(arrival))
    tops = events.groupBy(hour.alias("_h")).agg(F.max(ts).alias("_m"))
    before = F.max("_m").over(Window.partitionBy(F.lit(0)).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1))
    return events.withColumn("_h", hour).join(tops.select("_h", before.alias("_top")), "_h", "left").drop("_h")


def late_rows(events: DataFrame, ts: str, arrival: str, delay_s: int) -> DataFrame:
    """Events that arrive more than the delay after the newest event time before them, by arrival hour."""
    return with_newest(events, ts, arrival).filter(F.col(ts) < F.col("_top") - F.make_dt_interval(secs=F.lit(delay_s))).drop("_top")


def affected(events: DataFrame, late: DataFrame, key: str, ts: str, width_s: int) -> DataFrame:
    """Rows whose trailing window holds a late row: those of its key in (t, t + width], found by cells of that width."""
    cell = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (width_s * 1_000_000))
    marks = late.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.explode(F.array(cell(F.col(ts)), cell(F.col(ts)) + 1)).alias("_c")).distinct()
    rows = events.withColumn("_cell", cell(F.col(ts)))
    hit = (rows[key] == marks["_k"]) & (rows["_cell"] == marks["_c"]) & (rows[ts] > marks["_t"]) & (rows[ts] <= marks["_t"] + F.make_dt_interval(secs=F.lit(width_s)))
    return rows.join(marks, hit, "left_semi").drop("_cell")
