"""Rows of a query and of its SQL, made alike."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "-"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.9g}"
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))
