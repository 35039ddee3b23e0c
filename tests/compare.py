"""Compare registered queries with their SQL oracles, order-insensitively."""

from __future__ import annotations

import datetime
import decimal
import math
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if hasattr(v, "asDict"):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def run_spark(df):
    cols = sorted(df.columns)
    rows = [[plain(r[c]) for c in cols] for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=repr)


def run_duck(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [[plain(r[i]) for i in order] for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(spark, con, sf_dir: str, fn, sql: str | None):
    """(problem or None, rows, spark seconds, duck seconds)"""
    t0 = time.time()
    cols, rows = run_spark(fn(spark, sf_dir))
    t1 = time.time()
    if sql is None:
        return (None if cols else "no columns"), len(rows), t1 - t0, 0.0
    dcols, drows = run_duck(con, sql)
    t2 = time.time()
    problem = None
    if cols != dcols:
        problem = f"columns {cols} != {dcols}"
    elif len(rows) != len(drows):
        problem = f"{len(rows)} rows != {len(drows)}"
    elif [[type(x).__name__ for x in r] for r in rows[:50]] != [[type(x).__name__ for x in r] for r in drows[:50]]:
        bad = next((i for i, (a, b) in enumerate(zip(rows, drows)) if a != b), 0)
        problem = f"types differ: {rows[bad]} != {drows[bad]}"
    elif rows != drows:
        bad = next(i for i, (a, b) in enumerate(zip(rows, drows)) if repr(a) != repr(b))
        n = sum(1 for a, b in zip(rows, drows) if repr(a) != repr(b))
        problem = f"{n} rows differ, first {rows[bad]} != {drows[bad]}"
    return problem, len(rows), t1 - t0, t2 - t1
