"""Run a query in Spark and its SQL in DuckDB and compare the results as bags of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

KIND = {
    "string": "text", "bigint": "int", "int": "int", "date": "date", "timestamp_ntz": "ts",
    "double": "float", "boolean": "bool",
    "VARCHAR": "text", "BIGINT": "int", "INTEGER": "int", "DATE": "date", "TIMESTAMP": "ts",
    "DOUBLE": "float", "BOOLEAN": "bool",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def value(v):
    if v is None:
        return "<null>"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def kind(t: str) -> str:
    return t.lower().replace(" ", "") if t.lower().startswith("decimal") else KIND.get(t, t)


def bag(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {n: kind(str(d[1])) for n, d in zip(names, result.description)}
    spark_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    if spark_types != types:
        return f"schema: spark {spark_types} sql {types}"
    want, got = bag(names, result.fetchall()), bag(df.columns, df.collect())
    if len(want) != len(got):
        return f"rows: spark {len(got)} sql {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(want)} rows differ, first spark {wrong[0][0]} sql {wrong[0][1]}"
    return None
