"""Compare registered queries with their SQL twins: ``python -m tests.oracle [--sf DIR] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v == int(v) and abs(v) < 1e15 else float(f"{v:.10g}")
    if type(v).__name__ == "Decimal":
        return norm(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, folder, fn, sql):
    df = fn(spark, folder)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got), 0, ""
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return False, len(got), len(want), f"columns {got_names} vs {want_names}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return False, len(got), len(want), f"{diff}"
    return True, len(got), len(want), ""


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from clipwell.session import spark_session

    folder = "/root/testdata/sf0.01"
    if argv and argv[0] == "--sf":
        folder, argv = argv[1], argv[2:]
    spark, con = spark_session("oracle"), connect(folder)
    qs, sqls = queries(), oracle_sql()
    names = [n for n in qs if not argv or any(n.startswith(a) for a in argv)]
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, a, b, note = compare(spark, con, folder, qs[n], sqls.get(n))
        except Exception as e:  # noqa: BLE001
            ok, a, b, note = False, 0, 0, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += ok is False
        mark = {True: "ok  ", False: "FAIL", None: "rows"}[ok]
        empty = " EMPTY" if not a else ""
        print(f"{mark} {n} {a}/{b} {time.time() - t:.1f}s{empty} {note}", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
