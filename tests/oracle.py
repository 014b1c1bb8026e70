"""Runs a query and its SQL and compares their rows."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or pd.isna(v) else round(v, 9) if isinstance(v, float) else v


def rows(frame: pd.DataFrame, columns: list[str]) -> list:
    return sorted(([plain(v) for v in r] for r in frame[columns].astype(object).values.tolist()), key=str)


def same(spark, con, sf_dir: str, query, sql: str) -> None:
    got, want = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
