"""Run queries beside their SQL twins: same columns, same rows, whatever the order.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, datetime.datetime)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) else v)
    try:
        return _plain(float(v)) if not isinstance(v, int) else v
    except TypeError:
        return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(spark_rows, spark_cols, sql_rows, sql_cols) -> str | None:
    if sorted(spark_cols) != sorted(sql_cols):
        return f"columns {sorted(spark_cols)} against {sorted(sql_cols)}"
    cols = sorted(spark_cols)

    def bag(rows, names):
        at = [names.index(c) for c in cols]
        return Counter(tuple(_plain(r[i]) for i in at) for r in rows)

    a, b = bag(spark_rows, list(spark_cols)), bag(sql_rows, list(sql_cols))
    if a != b:
        return f"{sum(a.values())} rows against {sum(b.values())}; only here {list((a - b).items())[:3]}, only there {list((b - a).items())[:3]}"
    return None


def check(spark, con, name, query, sql, sf_dir) -> str | None:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    cur = con.execute(sql)
    return differences(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from eavesgrid.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(8), duck(sf)
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = check(spark, con, name, fn, entry.oracle_sql().get(name), sf)
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {took:.1f}s {result or ''}", flush=True)
    print("failed:", bad)
