"""Run registered queries on Spark and their SQL on DuckDB; compare results.

Comparison is by column name (sorted), row count and the multiset of rows
after normalising values (floats by repr, timestamps by ISO text). Usage:

    python tools/oracle_compare.py [sf_dir] [key ...]

``VANILLA=1`` uses a session without the library's settings, as the driver
does; ``ORACLE_JSON=<file>`` also writes the results as JSON.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.oracle import ORACLE  # noqa: E402
from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.sources.tables import TABLE_NAMES, table_path  # noqa: E402


TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, con, sf_dir: str, key: str):
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if key not in ORACLE:
        return {"key": key, "ok": None, "rows": len(s_rows), "sec": round(t1 - t0, 2)}
    res = con.execute(ORACLE[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t1 - t0, 2)}
    out["cols_ok"] = sorted(s_cols) == sorted(d_cols)
    d_types = {r[0]: TYPE_NAMES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {ORACLE[key]}").fetchall()}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    out["types_ok"] = d_types == s_types
    if not out["types_ok"]:
        out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                        if s_types.get(c) != d_types.get(c)}
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["ok"] = out["cols_ok"] and out["types_ok"] and a == b
    if not out["ok"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["only_spark"], out["only_duck"] = diff_a, diff_b
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(QUERIES)
    if os.environ.get("VANILLA"):
        # a session as the driver builds it: none of the library's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        from tessera.session import local_session
        spark = local_session(8)
    con = duck(sf_dir)
    bad, results = 0, []
    for k in keys:
        try:
            r = compare(spark, con, sf_dir, k)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        results.append(r)
        print(r, flush=True)
    print(f"failures: {bad}")
    if os.environ.get("ORACLE_JSON"):
        import json
        with open(os.environ["ORACLE_JSON"], "w") as f:
            json.dump({"sf_dir": sf_dir, "failures": bad, "results": results}, f, indent=1, default=str)


if __name__ == "__main__":
    main()
