"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB and compare.

Comparison mirrors the driver's: same column names, same row count, and the
same multiset of rows (columns sorted by name, floats rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
from decimal import Decimal

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


# Spark simple type -> DuckDB type name (coarse: the types the checks produce).
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, sorted(rows, key=_key)


def compare(spark, name, sf_dir, con=None):
    import __spark_entry__ as E

    con = con or duck_connection(sf_dir)
    sdf = E.queries()[name](spark, sf_dir)
    s_cols, s_rows = spark_rows(sdf)
    d_cols, d_rows = duck_rows(con, E.oracle_sql()[name])
    problems = []
    rel = con.sql(E.oracle_sql()[name])
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    bad_types = {c: (t, d_types.get(c)) for c, t in s_types.items() if _TYPES.get(t, t) != d_types.get(c)}
    if bad_types:
        problems.append(f"types differ: {bad_types}")
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    return problems


if __name__ == "__main__":
    from verisift.session import local_session

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    con = duck_connection(sf)
    bad = 0
    for name in E.queries():
        if only and name not in only:
            continue
        try:
            probs = compare(spark, name, sf, con)
        except Exception as exc:  # report and continue
            probs = [f"error: {type(exc).__name__}: {str(exc)[:400]}"]
        print(("OK   " if not probs else "FAIL ") + name, *probs, sep="\n    " if probs else "", flush=True)
        bad += bool(probs)
    print(f"{bad} failing")
