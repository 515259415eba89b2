"""Spark result against DuckDB result: same columns, same types, same multiset of rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_SAME = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT",
         "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
         "timestamp": "TIMESTAMP"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, Decimal):
        return str(v)
    return v


def differences(spark_df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    problems = []
    names = sorted(spark_df.columns)
    if names != sorted(rel.columns):
        return [f"columns {names} vs {sorted(rel.columns)}"]
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in spark_df.schema:
        t = f.dataType.simpleString()
        want = _SAME.get(t, t.upper())
        if want != duck_types[f.name].upper():
            problems.append(f"type of {f.name}: {t} vs {duck_types[f.name]}")
    ours = Counter(tuple(_cell(v) for v in r) for r in spark_df.select(*names).collect())
    theirs = Counter(tuple(_cell(v) for v in r)
                     for r in rel.select(", ".join(f'"{n}"' for n in names)).fetchall())
    if ours != theirs:
        problems.append(
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours {list((ours - theirs).items())[:2]}; "
            f"only theirs {list((theirs - ours).items())[:2]}")
    elif not ours:
        problems.append("no rows")
    return problems
