"""Row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return str(Decimal(str(v)).normalize() + 0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(columns: list[str], data) -> list[tuple[str, ...]]:
    """Rows with columns in name order, as text, sorted."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(r[i]) for i in order) for r in data)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_differences(df, relation) -> list[str]:
    """Columns whose type differs between the engines."""
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    found = []
    for name, kind in df.dtypes:
        mine = KINDS.get(kind, kind.upper())
        if theirs.get(name) != mine:
            found.append(f"{name}: spark {mine}, duckdb {theirs.get(name)}")
    return found


def differences(df, db, sql: str) -> list[str]:
    """What differs between the Spark DataFrame and the statement's result; empty if nothing does."""
    relation = db.sql(sql)
    found = type_differences(df, relation)
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} / {sorted(relation.columns)}"]
    mine = rows(df.columns, df.collect())
    theirs = rows(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} / {len(theirs)}")
    if mine != theirs:
        a, b = set(mine) - set(theirs), set(theirs) - set(mine)
        found.append(f"{len(a)} / {len(b)} rows differ, e.g. {sorted(a)[:2]} / {sorted(b)[:2]}")
    return found
