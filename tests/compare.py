"""Run a query and its checking SQL over the same tables and compare the results as sets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    return v


def _types(frame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in frame.schema}


_SAME = {
    "string": {"VARCHAR", "JSON"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
}


def differences(frame, con, sql: str) -> str | None:
    """None if both sides hold the same columns, types and rows; else what differs."""
    names = sorted(frame.columns)
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    rows = found.fetchall()
    if sorted(columns) != names:
        return f"columns {names} vs {sorted(columns)}"
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    sql_types = {r[0]: r[1] for r in described}
    odd = {
        c: (t, sql_types[c])
        for c, t in _types(frame).items()
        if sql_types[c] not in _SAME.get(t, {t.upper()})
    }
    if odd:
        return f"types {odd}"
    order = [columns.index(n) for n in names]
    expected = Counter(tuple(_cell(r[i]) for i in order) for r in rows)
    actual = Counter(tuple(_cell(r[n]) for n in names) for r in frame.collect())
    if expected == actual:
        return None
    lost = list((expected - actual).elements())[:3]
    extra = list((actual - expected).elements())[:3]
    return (
        f"{sum(actual.values())} rows vs {sum(expected.values())}; "
        f"only SQL: {lost}; only Spark: {extra}"
    )
