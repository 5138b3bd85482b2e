"""Comparison of a Spark result with a SQL result over the same tables, without regard to row order."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sql_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(repr(row[i]) for i in order) for row in rows))


def assert_same(df, con, sql: str) -> int:
    want_names, want = canonical(*sql_rows(con, sql))
    got_names, got = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert got_names == want_names
    assert len(got) == len(want), (len(got), len(want))
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:5]
    return len(got)
