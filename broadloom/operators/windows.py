"""Trailing, tumbling and sliding windows, point-in-time joins, and scaler state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadloom.plans.arrays import column_moments
from broadloom.session import free_names

#: What each closed side adds to the lower and upper bound, in microseconds.
CLOSED = {"left": (0, -1), "right": (1, 0), "both": (0, 0), "neither": (1, -1)}


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def trailing_sum(df: DataFrame, key: str, ts: str, value: str, width_us: int, closed: str = "left", name: str = "total") -> DataFrame:
    """Adds the sum of ``value`` over the trailing window of each row; an empty window gives 0."""
    low, high = CLOSED[closed]
    w = Window.partitionBy(key).orderBy(micros(F.col(ts))).rangeBetween(-width_us + low, high)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def trailing_sums_split(df: DataFrame, key: str, ts: str, value: str, width_us: int, closed: dict[str, str], cell_us: int | None = None) -> DataFrame:
    """Adds a trailing sum for each ``name: closed side``, all from one split of the time line for hot keys.

    A key's time line is cut into cells, each with the last ``width`` of the one before.
    Rows are copied to the next cell at most once, so a key that holds much of the
    table is summed by as many tasks as it has cells. The table is read and shuffled once.
    """
    cell_us = max(cell_us or 4 * width_us, width_us + 2)
    at, cell, own = free_names(df, "at", "cell", "own")
    t = micros(F.col(ts))
    here = F.floor(t / cell_us)
    lent = F.when(t >= (here + 1) * cell_us - width_us - 1, F.struct((here + 1).alias("cell"), F.lit(False).alias("own")))
    places = F.array_compact(F.array(F.struct(here.alias("cell"), F.lit(True).alias("own")), lent))
    rows = df.withColumn(at, t).withColumn(cell, F.explode(places)).withColumn(own, F.col(f"{cell}.own")).withColumn(cell, F.col(f"{cell}.cell"))
    by = Window.partitionBy(key, cell).orderBy(at)
    sums = {name: F.coalesce(F.sum(value).over(by.rangeBetween(-width_us + CLOSED[side][0], CLOSED[side][1])), F.lit(0)) for name, side in closed.items()}
    return rows.withColumns(sums).filter(own).drop(at, cell, own)


def trailing_sum_split(df: DataFrame, key: str, ts: str, value: str, width_us: int, closed: str = "left", name: str = "total", cell_us: int | None = None) -> DataFrame:
    """``trailing_sum`` for hot keys; see ``trailing_sums_split``."""
    return trailing_sums_split(df, key, ts, value, width_us, {name: closed}, cell_us)


def tumbling(df: DataFrame, key: str, ts: str, value: str, width: str, closed: str = "left") -> DataFrame:
    """(key, window_start, total, n) of tumbling windows; closed right puts a border row into the window before."""
    t = F.col(ts) if closed == "left" else F.col(ts) - F.expr("INTERVAL '0.000001' SECOND")
    return df.groupBy(key, F.window(t, width).alias("w")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "total", "n")


def sliding(df: DataFrame, key: str, ts: str, value: str, width: str, slide: str) -> DataFrame:
    """(key, window_start, total, n) of sliding windows."""
    return df.groupBy(key, F.window(ts, width, slide).alias("w")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "total", "n")


def asof_join(points: DataFrame, features: DataFrame, key: str, at: str, available: str, values: list[str], cell_us: int = 24 * 3600 * 1_000_000) -> DataFrame:
    """Adds to each point the values of the newest feature row of its key that was available at that time.

    Both sides go through one shuffle as a union, cut into cells of time, so a hot key
    is many groups. Inside a cell the newest row is carried forward in time order; what
    a cell ends with is one row, carried to the cells after it. At equal times features
    come before points; a null time or key finds nothing.
    """
    time, side, found, cell = free_names(points, "time", "side", "found", "cell")
    names, kind = points.columns, features.select(F.struct(*values)).schema[0].dataType
    cut = F.floor(micros(F.col(time)) / cell_us)
    left = points.withColumn(time, F.col(at)).withColumn(side, F.lit(1)).withColumn(found, F.lit(None).cast(kind))
    right = features.filter(F.col(available).isNotNull()).select(
        *[F.col(c) if c == key else F.lit(None).cast(points.schema[c].dataType).alias(c) for c in names], F.col(available).alias(time), F.lit(0).alias(side), F.struct(*values).alias(found)
    )
    rows = left.unionByName(right).withColumn(cell, cut)
    inside = Window.partitionBy(key, cell).orderBy(time, side).rowsBetween(Window.unboundedPreceding, 0)
    points_in = rows.withColumn(found, F.last(found, ignorenulls=True).over(inside)).filter(F.col(side) == 1)
    # the last feature row of each cell, then the newest one of the cells before it
    last = right.withColumn(cell, cut).groupBy(key, cell).agg(F.max_by(found, time).alias("last"))
    wanted = points.filter(F.col(at).isNotNull() & F.col(key).isNotNull()).select(F.col(key), F.floor(micros(F.col(at)) / cell_us).alias(cell)).distinct()
    before = Window.partitionBy(key).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    carried = wanted.join(last, [key, cell], "full").withColumn("carried", F.last("last", ignorenulls=True).over(before)).filter("carried IS NOT NULL").select(key, cell, "carried")
    out = points_in.join(carried, [key, cell], "left")
    (value,) = free_names(out, "value")
    return out.withColumn(value, F.coalesce(F.col(found), F.col("carried"))).select(*names, *[F.col(f"{value}.{v}").alias(v) for v in values])


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, mean_value, scale_value) of the fitted rows, from one scan whatever the number of columns.

    Nulls are left out; the deviation is the population's, 1 where it is 0. A column
    with non-finite values has NaN for both, one without values null.
    """
    m = column_moments(df, columns)
    usable = F.col("non_finite") == 0
    scale = F.sqrt(F.col("m2") / F.nullif(F.col("finite"), F.lit(0)))
    return m.select(
        "column_name",
        F.when(usable, F.col("mean")).otherwise(F.lit(float("nan"))).alias("mean_value"),
        F.when(usable, F.when(scale == 0, 1.0).otherwise(scale)).otherwise(F.lit(float("nan"))).alias("scale_value"),
    )


def apply_scaler(df: DataFrame, state: DataFrame, columns: list[str], missing: float = 0.0) -> DataFrame:
    """``df`` with scaled columns; null takes ``missing``. The state, a row for each column, becomes one row of two arrays in the order of ``columns``."""
    order = state.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column_name string")
    listed = F.array_sort(F.collect_list(F.struct("place", "mean_value", "scale_value")))
    one = order.join(state, "column_name", "left").agg(listed.alias("x"))  # as many entries as columns
    mean, scale = free_names(df, "mean_values", "scale_values")
    joined = df.crossJoin(F.broadcast(one.select(F.col("x.mean_value").alias(mean), F.col("x.scale_value").alias(scale))))  # one row
    scaled = {c: F.coalesce((F.col(c) - F.element_at(mean, k + 1)) / F.element_at(scale, k + 1), F.lit(missing)) for k, c in enumerate(columns)}
    return joined.withColumns(scaled).select(*df.columns)
