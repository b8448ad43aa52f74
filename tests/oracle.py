"""Runs a query and its SQL form on the same tables and tells how they differ."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if isinstance(x, (list, tuple, np.ndarray)):
            return tuple(cell(y) for y in x)
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, (bool, np.bool_)):
            return bool(x)
        if isinstance(x, (pd.Timestamp, np.datetime64)):
            return pd.Timestamp(x).tz_localize(None) if pd.Timestamp(x).tz is None else pd.Timestamp(x).tz_convert("UTC").tz_localize(None)
        if isinstance(x, (int, np.integer)):
            return float(x)
        if isinstance(x, (float, np.floating)):
            return round(float(x), 9) + 0.0
        return x

    df = df[sorted(df.columns)]
    return sorted((tuple(cell(x) for x in row) for row in df.itertuples(index=False, name=None)), key=repr)


def difference(spark, con, sf_dir, query, sql) -> str | None:
    """None if both give the same rows, else what differs."""
    got, want = query(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = _plain(got), _plain(want)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows; {a[:2]} {b[:2]}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} of {len(a)} rows, first {bad[0]}" if bad else None
