"""Run a query beside its SQL and compare names, types, rows and values."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return "float"
    if isinstance(value, datetime.date):
        return "date"
    return type(value).__name__


def norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {names[i]: {kind(r[i]) for r in rows} - {None} for i in order}
    return [names[i] for i in order], kinds, Counter(tuple(norm(r[i]) for i in order) for r in rows)


def spark_side(df):
    rows = [tuple(r) for r in df.collect()]
    return table(df.columns, rows)


def duck_side(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return table(names, cursor.fetchall())


def differences(left, right) -> list[str]:
    out = []
    if left[0] != right[0]:
        out.append(f"columns {left[0]} vs {right[0]}")
        return out
    for name in left[0]:
        a, b = left[1][name], right[1][name]
        if a and b and a != b:
            out.append(f"type of {name}: {a} vs {b}")
    n, m = sum(left[2].values()), sum(right[2].values())
    if n != m:
        out.append(f"rows {n} vs {m}")
    extra, missing = left[2] - right[2], right[2] - left[2]
    if extra or missing:
        out.append(f"{sum(extra.values())} extra / {sum(missing.values())} missing")
        out.append(f"  spark {sorted(extra, key=str)[:3]}")
        out.append(f"  duck  {sorted(missing, key=str)[:3]}")
    return out
