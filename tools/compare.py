"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/compare.py [sf_dir] [name ...]

Checks row count, column names and an order-insensitive comparison of
values (floats at 1e-6), like the driver's correctness gate.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from carecast.oracle import oracle_sql  # noqa: E402
from carecast.registry import queries  # noqa: E402
from carecast.session import local_session  # noqa: E402

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


DUCK_TO_SPARK = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "HUGEINT": "hugeint", "DECIMAL": "decimal",
    "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint",
}


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        path = os.path.join(sf_dir, f"{v}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir, name, sql, query=None):
    t0 = time.time()
    sdf = (query or queries()[name])(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return problems, len(s_rows), len(d_rows), t1 - t0, t2 - t1
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]) for d in res.description}
    for c in s_cols:
        want = DUCK_TO_SPARK.get(d_types[c].split("(")[0].upper(), d_types[c])
        if want != s_types[c]:
            problems.append(f"type of {c}: spark={s_types[c]} duck={d_types[c]}")
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sn = sorted((tuple(norm(r[i]) for i in si) for r in s_rows), key=key)
    dn = sorted((tuple(norm(r[i]) for i in di) for r in d_rows), key=key)
    if len(sn) != len(dn):
        problems.append(f"row count spark={len(sn)} duck={len(dn)}")
    bad = 0
    for a, b in zip(sn, dn):
        if a != b:
            ok = all(
                (x == y) or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6)
                for x, y in zip(a, b)
            )
            if not ok:
                if bad < 3:
                    problems.append(f"row differs:\n  spark={a}\n  duck ={b}\n  cols={order}")
                bad += 1
    if bad:
        problems.append(f"{bad} differing rows")
    return problems, len(s_rows), len(d_rows), t1 - t0, t2 - t1


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = local_session(cores=8, shuffle_partitions=8)
    con = duck(sf_dir)
    sqls = oracle_sql()
    names = names or list(queries())
    failed = 0
    for n in names:
        if n not in sqls:
            print(f"{n:28s} (no oracle)")
            continue
        try:
            problems, ns, nd, ts, td = compare(spark, con, sf_dir, n, sqls[n])
        except Exception as e:  # noqa: BLE001
            problems, ns, nd, ts, td = [f"error: {type(e).__name__}: {str(e)[:800]}"], -1, -1, 0, 0
        status = "OK " if not problems else "BAD"
        failed += bool(problems)
        print(f"{status} {n:28s} spark_rows={ns:<7} duck_rows={nd:<7} spark={ts:.2f}s duck={td:.2f}s")
        for pr in problems:
            print("    " + pr)
    print(f"{failed} failing of {len(names)}")
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
