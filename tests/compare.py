"""Order-insensitive comparison of a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

DATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normalized(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if both hold the same columns and rows, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    left, right = normalized(spark_frame), normalized(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} and {b}"
    # The unit of a time is the reader's choice: nanoseconds here, microseconds there.
    kinds = [(c, *(str(f[c].dtype).replace("[ns]", "[us]") for f in (spark_frame, sql_frame))) for c in sorted(spark_frame.columns)]
    odd = [k for k in kinds if k[1] != k[2]]
    return f"dtypes {odd}" if odd else None
