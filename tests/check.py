"""Compare registered queries with their DuckDB oracles (row count, column names,
order-insensitive value hash), the way the driver's correctness gate does.

    python -m tests.check [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

# Spark simple type -> DuckDB type name (the schema half of the comparison).
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE"}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(norm).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir: str, names: list[str] | None = None) -> dict:
    from newsmart.plans import load_queries
    from newsmart.session import build_session

    spark = build_session("newsmart-check", master="local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    results = {}
    for name, q in load_queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.fn(spark, sf_dir)
            s_rows = [tuple(r) for r in df.collect()]
            s_cols, s_n, s_h = digest(df.columns, s_rows)
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            print(name, results[name], flush=True)
            continue
        t_spark = time.time() - t0
        if q.oracle is None:
            results[name] = {"ok": None, "rows": s_n, "sec": round(t_spark, 2), "oracle": "none"}
            print(name, results[name], flush=True)
            continue
        try:
            duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {q.oracle}").fetchall()}
            cur = con.execute(q.oracle)
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            d_cols, d_n, d_h = digest(d_cols, d_rows)
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"duckdb: {type(e).__name__}: {str(e)[:400]}"}
            print(name, results[name], flush=True)
            continue
        spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in df.schema.fields}
        types_ok = spark_types == duck_types
        ok = s_cols == d_cols and s_n == d_n and s_h == d_h and types_ok
        results[name] = {
            "ok": ok, "rows": s_n, "oracle_rows": d_n, "sec": round(t_spark, 2),
            **({} if s_cols == d_cols else {"spark_cols": s_cols, "oracle_cols": d_cols}),
            **({} if types_ok else {"spark_types": spark_types, "oracle_types": duck_types}),
        }
        print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad if bad else "none", f"({len(res)} checked)")
    sys.exit(1 if bad else 0)
