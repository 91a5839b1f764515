"""Compare a query with its SQL on DuckDB: names, row count, values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from gridloom.sources.sql import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return v


def _table(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    rows = [tuple(_value(v) for v in row) for row in frame[names].itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {n: str(frame[n].dtype) for n in sorted(frame.columns)}


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when equal, else what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    # whole numbers with nulls: pandas has floats from one side and nullable integers from the other
    spark_frame = spark_frame.astype({n: "Int64" for n, k in kinds(sql_frame).items()
                                      if k == "Int64" and spark_frame[n].isna().any()})
    if kinds(spark_frame) != kinds(sql_frame):
        return f"types {kinds(spark_frame)} / {kinds(sql_frame)}"
    for a, b in zip(_table(spark_frame), _table(sql_frame)):
        if a != b:
            return f"values {a} / {b}"
    return None
