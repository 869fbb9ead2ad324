"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (decimal.Decimal, int)) and not isinstance(value, bool):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql: str) -> list[str]:
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    described = [(d[0], str(d[1])) for d in result.description]
    want_names, want = rows_of([n for n, _ in described], result.fetchall())
    found = []
    if got_names != want_names:
        found.append(f"columns {got_names} != {want_names}")
        return found
    types = dict(described)
    for name, dtype in spark_df.dtypes:
        if SAME_TYPE.get(dtype) != types[name]:
            found.append(f"type of {name}: {dtype} != {types[name]}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"[:600])
    return found


def data_dir(sf: str) -> str:
    return os.path.join(os.environ.get("QUERN_TESTDATA", "/root/testdata"), f"sf{sf}")


def has_data(sf: str) -> bool:
    return bool(glob.glob(os.path.join(data_dir(sf), "*.parquet")))
