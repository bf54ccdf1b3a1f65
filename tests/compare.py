"""Compare a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].where(df[c].notna(), None).map(lambda v: "∅" if v is None else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> list[str]:
    """Strict: same columns, kinds of types, rows and printed values."""
    out = []
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return [f"columns {set(spark_df.columns) ^ set(sql_df.columns)}"]
    if len(spark_df) != len(sql_df):
        return [f"rows {len(spark_df)} != {len(sql_df)}"]
    for c in spark_df.columns:
        if spark_df[c].dtype.kind != sql_df[c].dtype.kind:
            out.append(f"type of {c}: {spark_df[c].dtype} != {sql_df[c].dtype}")
    a, b = _normal(spark_df), _normal(sql_df)
    for c in a.columns:
        bad = a[c] != b[c]
        if bad.any():
            i = bad.idxmax()
            out.append(f"{c}: {int(bad.sum())} differ, e.g. {a[c][i]} != {b[c][i]}")
    return out
