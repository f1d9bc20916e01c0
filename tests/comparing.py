"""Compare a registered query with its SQL counterpart."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def oracle_rows(sql: str, folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def plain(value):
    if isinstance(value, float):
        return value if math.isfinite(value) else str(value)
    if isinstance(value, Decimal):
        return str(value)
    return value


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, folder: str) -> list[str]:
    """What differs, empty when names, types of values and rows agree."""
    columns, rows = oracle_rows(sql, folder)
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(set(df.columns) ^ set(columns))}"]
    ours, theirs = counted(df.columns, df.collect()), counted(columns, rows)
    found = []
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"rows {sum(ours.values())} against {sum(theirs.values())}")
    names = sorted(columns)
    if ours != theirs:
        extra, missing = list((ours - theirs))[:3], list((theirs - ours))[:3]
        found.append(f"columns {names}\nonly ours {extra}\nonly theirs {missing}")
    return found
