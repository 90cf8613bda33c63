"""Run a registered query and its SQL statement side by side."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_plain(v) for v in r) for r in frame.itertuples(index=False, name=None)),
                  key=repr)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: str(frame[c].dtype) for c in sorted(frame.columns)}


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """Why the two results differ, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    if kinds(spark_frame) != kinds(sql_frame):
        return f"types {kinds(spark_frame)} != {kinds(sql_frame)}"
    for a, b in zip(rows(spark_frame), rows(sql_frame)):
        if a != b:
            return f"value {a} != {b}"
    return None
