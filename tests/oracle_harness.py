"""Run registered queries in Spark and their SQL twins in DuckDB, and compare.

Strict: same row count, same column names, same multiset of rows with floats
compared by their exact value. Usable from pytest and as a script:

    python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if v == int(v) and abs(v) < 2**53:
            return ("n", int(v))
        return ("f", v)
    if isinstance(v, decimal.Decimal):
        return ("f", float(v)) if v != int(v) else ("n", int(v))
    if isinstance(v, _dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, _dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return ("r", tuple(_norm(x) for x in v))
    return ("s", str(v))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["status"] = "columns differ"
        out["detail"] = {"spark_only": sorted(set(s_cols) - set(d_cols)), "oracle_only": sorted(set(d_cols) - set(s_cols))}
        return out
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    cs = Counter(tuple(_norm(v) for v in r) for r in s_rows)
    cd = Counter(tuple(_norm(v) for v in r) for r in d_rows)
    if cs == cd:
        out["status"] = "match"
    else:
        out["status"] = "values differ"
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        out["detail"] = {"columns": s_cols, "spark_only": only_s, "oracle_only": only_d,
                         "n_spark_only": sum((cs - cd).values()), "n_oracle_only": sum((cd - cs).values())}
    return out


def main(argv: list[str]) -> int:
    import time

    import __spark_entry__ as entry
    from tripflow.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session(shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
