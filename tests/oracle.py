"""Compare a registered query with its SQL oracle, cell by cell."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from millrace.queries import REGISTRY
from millrace.queries.registry import TABLE_NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return "<null>"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"float:{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"dec:{value.normalize():f}"
    if isinstance(value, int):
        return f"int:{value}"
    if isinstance(value, datetime.datetime):
        return f"ts:{value.replace(tzinfo=None).isoformat()}"
    if isinstance(value, datetime.date):
        return f"date:{value.isoformat()}"
    if isinstance(value, (bytes, bytearray)):
        return f"bin:{bytes(value).hex()}"
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [names[i] for i in order]


def compare(spark, con, folder, name):
    """Returns (row count, list of differences)."""
    q = REGISTRY[name]
    df = q.run(spark, folder)
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if q.sql is None:
        return len(got), []
    cur = con.execute(q.sql)
    want_names = [d[0] for d in cur.description]
    want, want_names = rows_of(want_names, cur.fetchall())
    if got_names != want_names:
        return len(got), [f"columns {got_names} != {want_names}"]
    if got == want:
        return len(got), []
    diffs = [f"rows {len(got)} vs {len(want)}"]
    got_set, want_set = set(got), set(want)
    diffs += [f"only spark: {r}" for r in sorted(got_set - want_set)[:3]]
    diffs += [f"only sql:   {r}" for r in sorted(want_set - got_set)[:3]]
    return len(got), diffs
