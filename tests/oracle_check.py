"""Spark query vs DuckDB oracle on the driver's tables: names, row count, exact row multiset.

Usable from pytest (``tests/test_oracle.py``) and as a script:
``python tests/oracle_check.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    return str(v)


def rows(df: pd.DataFrame) -> Counter:
    cols = sorted(df.columns)
    df = df[cols].astype(object).where(pd.notna(df[cols]), None)
    return Counter(tuple(_norm(v) for v in r) for r in df.itertuples(index=False, name=None))


def py_rows(names, tuples) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(t[i]) for i in order) for t in tuples)


def compare(spark, con, key: str, sf_dir: str, query, sql: str) -> dict:
    sdf = query(spark, sf_dir)
    s_names, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    o_names, o_rows = [d[0] for d in cur.description], cur.fetchall()
    res = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(o_rows)}
    res["names"] = sorted(s_names) == sorted(o_names)
    if not res["names"]:
        res["detail"] = f"spark {sorted(s_names)} oracle {sorted(o_names)}"
        res["ok"] = False
        return res
    rs, ro = py_rows(s_names, s_rows), py_rows(o_names, o_rows)
    res["ok"] = rs == ro
    if not res["ok"]:
        only_s = list((rs - ro).elements())[:3]
        only_o = list((ro - rs).elements())[:3]
        res["detail"] = f"cols {sorted(s_names)}\n spark-only {only_s}\n oracle-only {only_o} (n={sum((rs-ro).values())})"
    return res


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import time
    from salesmart.session import get_spark
    from __spark_entry__ import oracle_sql, queries
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    Q, O = queries(), oracle_sql()
    bad = 0
    for k in (keys or list(Q)):
        if k not in O:
            t = time.time()
            n = Q[k](spark, sf).count()
            print(f"ROWS  {k}: {n} rows ({time.time()-t:.1f}s)", flush=True)
            continue
        t = time.time()
        try:
            r = compare(spark, con, k, sf, Q[k], O[k])
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "ok": False, "detail": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += not r["ok"]
        print(("OK   " if r["ok"] else "FAIL ") + f"{k}: {r.get('spark_rows')} / {r.get('oracle_rows')} ({time.time()-t:.1f}s)", flush=True)
        if not r["ok"]:
            print("   ", r.get("detail"), flush=True)
    print("failures:", bad)


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT",
}


def type_diffs(spark_df, con, sql: str) -> list:
    rel = con.sql(sql)
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = []
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(st, st.upper())
        got = duck_types.get(f.name)
        if got != want:
            out.append((f.name, st, got))
    return out
