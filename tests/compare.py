"""Run a registered query and its checking SQL, and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def mismatch(query, sql, spark, sf_dir, connection) -> str | None:
    """None when both sides give the same columns and rows, else what differs."""
    frame = query(spark, sf_dir)
    ours = frame.collect()
    if sql is None:
        return None if ours else "no rows"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = rows_of(frame.columns, ours), rows_of(names, theirs)
    if left == right:
        return None
    only = [r for r in left if r not in set(right)][:3], [r for r in right if r not in set(left)][:3]
    return f"{len(left)} rows against {len(right)}; columns {sorted(names)}; only ours {only[0]}; only theirs {only[1]}"
