"""Runs a query and its SQL side by side, as multisets of rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"


def connect(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple("\0" if v is None else repr(v) for v in row)


def same(con, df, sql: str) -> None:
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_key)
