"""Compare every registered query with its DuckDB oracle (as the driver does).

Row count, column names and an order-insensitive exact comparison of values
(columns sorted by name).  Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(
        (tuple(_norm(r[k]) for k in order) for r in rows), key=lambda t: tuple(map(str, t))
    )


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    secs = time.time() - t0
    sql = entry.oracle_sql().get(name)
    out = {"name": name, "rows": len(srows), "secs": round(secs, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out["oracle_rows"] = len(drows)
    if sorted(dcols) != sorted(sdf.columns):
        out["status"] = f"SCHEMA {sorted(sdf.columns)} != {sorted(dcols)}"
        return out
    a, b = _rows(sdf.columns, srows), _rows(dcols, drows)
    if a == b:
        out["status"] = "MATCH"
    else:
        diff = [x for x in a if x not in set(b)][:3]
        other = [x for x in b if x not in set(a)][:3]
        out["status"] = f"VALUES differ: spark-only {diff} oracle-only {other}"
    return out


def main(argv):
    from martflow.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    names = argv[2:] or list(entry.queries())
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
