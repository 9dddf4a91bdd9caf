"""Run registered queries against their DuckDB oracle SQL (the driver's
correctness gate, reproduced locally).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from eventide.plans.catalog import spark_queries, oracle_queries
    qs, sqls = spark_queries(), oracle_queries()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            report[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, report[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            report[name] = f"rows-only {len(spdf)}"
            print(f"{name:28s} rows-only rows={len(spdf)} spark={ts:.1f}s", flush=True)
            continue
        try:
            opdf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            report[name] = f"SQL ERROR {e}"
            print(name, report[name], flush=True)
            continue
        ok_cols = sorted(spdf.columns) == sorted(opdf.columns)
        a, b = (rows_of(spdf), rows_of(opdf)) if ok_cols else ([], [])
        same = ok_cols and a == b
        diff = ""
        if ok_cols and not same:
            sa, sb = set(a), set(b)
            diff = f" only_spark={list(sa - sb)[:2]} only_sql={list(sb - sa)[:2]}"
        elif not ok_cols:
            diff = f" cols spark={sorted(spdf.columns)} sql={sorted(opdf.columns)}"
        report[name] = "OK" if same else "MISMATCH"
        print(f"{name:28s} {report[name]:8s} rows={len(spdf)}/{len(opdf)} spark={ts:.1f}s{diff}",
              flush=True)
    return report


if __name__ == "__main__":
    from eventide.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    rep = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if v not in ("OK",) and not v.startswith("rows-only")]
    print("FAILED:", bad)
