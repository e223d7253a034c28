"""Compare registered Spark queries with their DuckDB oracle SQL.

Row count, column names and an order-insensitive multiset of normalised rows
(columns sorted by name, floats rounded to 6 places) must agree.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(columns)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        got_rows = [tuple(r) for r in df.collect()]
        got, got_cols = rows_of(df.columns, got_rows)
        t_spark = time.time() - t0
        res = {"rows": len(got), "spark_s": round(t_spark, 2)}
        if name in sql:
            rel = con.sql(sql[name])
            exp, exp_cols = rows_of(rel.columns, rel.fetchall())
            res["oracle_rows"] = len(exp)
            res["columns_match"] = got_cols == exp_cols
            diff_a = Counter(got) - Counter(exp)
            diff_b = Counter(exp) - Counter(got)
            res["values_match"] = not diff_a and not diff_b
            if not res["values_match"] and verbose:
                res["spark_only"] = list(diff_a.elements())[:3]
                res["oracle_only"] = list(diff_b.elements())[:3]
            if not res["columns_match"]:
                res["spark_cols"] = [c for c in got_cols if c not in exp_cols]
                res["oracle_cols"] = [c for c in exp_cols if c not in got_cols]
        report[name] = res
        if verbose:
            print(name, res, flush=True)
    return report


if __name__ == "__main__":
    from trendspark.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})
    rep = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if not (v.get("values_match", True) and v.get("columns_match", True))]
    print("MISMATCH:", bad)
    print(f"{len(rep) - len(bad)}/{len(rep)} match")
