"""Rows of a Spark query against rows of DuckDB SQL on the same tables."""

import datetime
import math
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def connect(folder: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def same_rows(df, con, sql: str) -> None:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    assert got == want
