"""Run one query on Spark and its SQL on DuckDB and compare whole results, order aside."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value



def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()
