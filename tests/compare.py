"""Order-free comparison of a Spark result with the oracle's."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v: object) -> str:
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, Decimal):
        return format(v, "f")
    return repr(v)


def rows(names: list[str], data: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} against {sorted(want_names)}"
    mine, theirs = rows(df.columns, [tuple(r) for r in got]), rows(want_names, cur.fetchall())
    if mine == theirs:
        return None
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}\n"
        f"only here: {list((mine - theirs).items())[:3]}\nonly there: {list((theirs - mine).items())[:3]}"
    )
