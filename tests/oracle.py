"""Compares a query with its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd


def _cell(v):
    if isinstance(v, list | tuple | np.ndarray):
        return str([_cell(x) for x in v])
    if isinstance(v, dict):
        return str({k: _cell(x) for k, x in v.items()})
    if pd.isna(v):
        return None
    if isinstance(v, bool | np.bool_):
        return str(bool(v))
    if isinstance(v, int | float | np.number):
        return f"{float(v) + 0.0:.6g}"
    return str(v).removesuffix(" 00:00:00")


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted((tuple(map(_cell, r)) for r in df.itertuples(index=False)), key=str)


def expected(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con.execute(sql).df()


def same(spark_df, sql: str, sf_dir: str) -> None:
    found, wanted = spark_df.toPandas(), expected(sql, sf_dir)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)
