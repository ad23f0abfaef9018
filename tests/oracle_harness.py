"""Compare registered Spark queries with their DuckDB SQL, as the driver does:
row count, column names and types, order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return repr(round(f, 6) + 0.0)
    return str(v)


def _digest(rows, names, order) -> tuple[int, str]:
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    out = {"query": name, "spark_s": round(t1 - t0, 2), "rows": (len(s_rows), len(d_rows))}
    if sorted(s_names) != sorted(d_names):
        out["columns"] = (sorted(set(s_names) - set(d_names)), sorted(set(d_names) - set(s_names)))
        out["ok"] = False
        return out
    s_order = sorted(range(len(s_names)), key=lambda i: s_names[i])
    d_order = sorted(range(len(d_names)), key=lambda i: d_names[i])
    st = [s_types[i] for i in s_order]
    dt = [d_types[i] for i in d_order]
    if st != dt:
        out["types"] = [(s_names[i], a, b) for i, a, b in zip(s_order, st, dt) if a != b]
    sn, sh = _digest(s_rows, s_names, s_order)
    dn, dh = _digest(d_rows, d_names, d_order)
    out["hash"] = sh == dh
    out["ok"] = sn == dn and sh == dh and "types" not in out
    if not out["hash"]:
        a = sorted("|".join(_canon(r[i]) for i in s_order) for r in s_rows)
        b = sorted("|".join(_canon(r[i]) for i in d_order) for r in d_rows)
        out["first_diff"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
        out["cols"] = [s_names[i] for i in s_order]
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from lagframe.session import get_session
    sf_dir = "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print({"query": name, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, name, fn, sqls[name], sf_dir, con)
        except Exception as ex:  # report and continue
            r = {"query": name, "ok": False, "error": str(ex)[:800]}
        bad += not r.get("ok")
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv)
