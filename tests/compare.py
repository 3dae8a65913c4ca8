"""Run one query on Spark and its SQL on DuckDB, and compare the rows as multisets."""

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v := plain(r[i])).__name__, v) for i in order) for r in data)


def differences(df, con, sql) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours, theirs = rows(df.columns, df.collect()), rows(names, cursor.fetchall())
    lost, extra = theirs - ours, ours - theirs
    if not lost and not extra:
        return []
    return [f"{sum(lost.values())} missing, {sum(extra.values())} extra of {sum(theirs.values())}"] + [
        f"missing {r}" for r in list(lost)[:2]
    ] + [f"extra {r}" for r in list(extra)[:2]]
