"""Compare a query with its DuckDB twin: same columns, same rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, decimal.Decimal)):
        return str(int(v)) if int(v) == v else repr(float(v))
    if isinstance(v, float):
        return "None" if math.isnan(v) else str(int(v)) if v == int(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(list(map(plain, v))) if isinstance(v, (list, tuple)) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> str:
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} and {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} and {len(theirs[1])} rows; only here {sorted(set(mine[1]) - set(theirs[1]))[:3]}, only there {sorted(set(theirs[1]) - set(mine[1]))[:3]}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(mine[1])} rows differ: {wrong[:3]}" if wrong else ""
