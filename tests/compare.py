"""Run a query in Spark and its SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), round(v, 6) if isinstance(v, float) else v) for v in row)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return type(a) is type(b) and a == b


def differences(frame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} / {sorted(names)}"]
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall()), key=sort_key)
    got = sorted((tuple(plain(r[c]) for c in order) for r in frame.collect()), key=sort_key)
    if len(got) != len(want):
        return [f"{len(got)} rows / {len(want)}"]
    return [
        f"{order}: {g} / {w}" for g, w in zip(got, want) if not all(same(x, y) for x, y in zip(g, w))
    ]
