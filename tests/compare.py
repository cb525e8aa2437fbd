"""Run registered queries next to their SQL and compare the rows.

    python tests/compare.py [scale] [name-part ...]
"""

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, run, sql):
    """None when equal, else what differs."""
    df = run(spark, sf)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got[1] else "no rows"
    result = con.execute(sql)
    want = rows_of([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {str(a)[:600]} != {str(b)[:600]} ({sum(x != y for x, y in zip(got[1], want[1]))} of {len(want[1])})"
    return None


if __name__ == "__main__":
    from speechframe.session import local_session

    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf = f"/root/testdata/sf{scale}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and not any(p in name for p in sys.argv[2:]):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, run, oracle.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in oracle else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
