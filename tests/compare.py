"""Compare a Spark result with its SQL counterpart, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        if math.isfinite(value) and value == int(value):
            return str(int(value))
        return f"{value:.6f}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """``None`` if equal, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    mine = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {str(wrong[0])[:600]}" if wrong else None
