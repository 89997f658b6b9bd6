"""Run a query and its SQL counterpart and compare schema and values."""

from __future__ import annotations

import decimal
import glob
import os
import time

import duckdb

NAMES = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "integer": "int32", "bigint": "int64",
    "string": "text", "varchar": "text", "double": "float64", "boolean": "bool",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return repr(v + 0.0) if v else "0.0"
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    return str(v)


def compare(spark, con, sf_dir, run, sql):
    """(problems, rows, seconds in Spark, seconds in SQL)"""
    t = time.time()
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    mine = df.select(*[f"`{n}`" for n in names]).collect()
    spark_time = time.time() - t
    if sql is None:
        return [], len(mine), spark_time, None
    t = time.time()
    rel = con.execute(sql)
    described = {d[0]: str(d[1]).lower() for d in rel.description}
    rows = rel.fetchall()
    sql_time = time.time() - t
    problems = []
    if sorted(described) != names:
        return [f"columns {names} / {sorted(described)}"], len(mine), spark_time, sql_time
    for field in df.select(*[f"`{n}`" for n in names]).schema.fields:
        a = NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        b = NAMES.get(described[field.name], described[field.name])
        if a != b:
            problems.append(f"type of {field.name}: {a} / {b}")
    order = [[d[0] for d in rel.description].index(n) for n in names]
    left = sorted(tuple(_plain(v) for v in r) for r in mine)
    right = sorted(tuple(_plain(r[i]) for i in order) for r in rows)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        problems.append(f"only here {sorted(a - b)[:3]} only sql {sorted(b - a)[:3]} ({len(a - b)}, {len(b - a)})")
    return problems, len(mine), spark_time, sql_time
