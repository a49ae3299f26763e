"""Comparison of a registered query with its SQL, as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(con, frame, sql: str) -> tuple[int, str | None]:
    """Row count and, where they differ, a description of how."""
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return sum(got.values()), f"columns {frame.columns} and {columns}"
    if got != want:
        extra, missing = got - want, want - got
        return sum(got.values()), (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"{sum(extra.values())} too many {list(extra)[:3]}; "
            f"{sum(missing.values())} missing {list(missing)[:3]}"
        )
    return sum(got.values()), None
