"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as e

    con = con or duck(sf_dir)
    df = e.queries()[key](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols, s_vals = rows_of(df.columns, s_rows)
    res = con.execute(e.oracle_sql()[key])
    d_cols_raw = [d[0] for d in res.description]
    d_cols, d_vals = rows_of(d_cols_raw, res.fetchall())
    ok = s_cols == d_cols and s_vals == d_vals
    info = {"key": key, "ok": ok, "spark_rows": len(s_vals), "oracle_rows": len(d_vals)}
    if not ok:
        info["spark_cols"] = s_cols
        info["oracle_cols"] = d_cols
        diff_s = [r for r in s_vals if r not in set(d_vals)][:3]
        diff_d = [r for r in d_vals if r not in set(s_vals)][:3]
        info["only_spark"] = diff_s
        info["only_oracle"] = diff_d
    return info


if __name__ == "__main__":
    from matchstream.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as e

    con = duck(sf)
    bad = 0
    for k in keys or sorted(e.oracle_sql()):
        try:
            info = compare(spark, k, sf, con)
        except Exception as exc:  # report and continue
            info = {"key": k, "ok": False, "error": repr(exc)[:500]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
