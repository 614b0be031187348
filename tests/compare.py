"""Spark-vs-DuckDB comparison used by the oracle tests and by hand.

Compares row count, column names, and the order-insensitive multiset of rows
(exact values; NaN equals NaN; -0.0 equals 0.0).
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_idx[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        return False, f"row count differs: spark={len(s_norm)} duck={len(d_norm)}"
    bad = [(a, b) for a, b in zip(s_norm, d_norm) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(s_norm)} rows match"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry  # noqa: E402
    from pitchside.session import build_session  # noqa: E402

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    con = duck(sf)
    qs, oracle = entry.queries(), entry.oracle_sql()
    for name in names or list(qs):
        if name not in oracle:
            n = qs[name](spark, sf).count()
            print(f"{name:28s} NO-ORACLE rows={n}")
            continue
        try:
            ok, msg = compare(qs[name](spark, sf), con, oracle[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}")
