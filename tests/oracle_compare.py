"""Run a registered job on Spark and its reference SQL on DuckDB; compare row count,
column names and the multiset of rows (order-insensitive)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (pd.Timestamp,)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple, str)) and pd.isna(x)) else x)
                         for x in rec))
    return sorted(out)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = False) -> tuple[bool, str]:
    sys.path.insert(0, REPO)
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    spdf = sdf.toPandas()
    for f in sdf.schema.fields:  # nullable integers arrive as floats
        if f.dataType.typeName() in ("integer", "long"):
            spdf[f.name] = spdf[f.name].astype("Int64")
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return False, f"{name}: rows={len(spdf)}, but no SQL to compare with"
    dpdf = con.execute(sql).df()
    t2 = time.time()
    if sorted(spdf.columns) != sorted(dpdf.columns):
        return False, f"{name}: columns differ spark={sorted(spdf.columns)} duck={sorted(dpdf.columns)}"
    a, b = _rows(spdf), _rows(dpdf)
    if len(a) != len(b):
        return False, f"{name}: row count spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, e.g. {diff}"
    return True, f"{name}: OK rows={len(a)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"


if __name__ == "__main__":
    sys.path.insert(0, REPO)
    from streamlens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    import __spark_entry__ as E
    con = duck(sf)
    bad = 0
    for n in names or list(E.queries()):
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{bad} failing")
