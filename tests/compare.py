"""Spark's rows against DuckDB's, as multisets of texts."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return repr(float(v))
    if isinstance(v, datetime):
        return v.isoformat()
    return v.isoformat() if isinstance(v, date) else str(v)


def same(df, sql: str, sf_dir: str) -> None:
    con = connect(sf_dir)
    names = sorted(df.columns)
    mine = sorted(tuple(cell(r[c]) for c in names) for r in df.collect())
    described = [r[0] for r in con.sql(f"DESCRIBE {sql}").fetchall()]
    assert sorted(described) == names
    order = [described.index(c) for c in names]
    other = sorted(tuple(cell(r[i]) for i in order) for r in con.sql(sql).fetchall())
    assert mine == other
