"""Run a named query and its SQL answer on the same tables and compare the rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = cur.fetchall()
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark, con, query, sql, sf):
    """None when equal, else a short text."""
    a, b = spark_rows(query(spark, sf)), duck_rows(con, sql)
    if a[0] != b[0]:
        return f"columns {a[0]} vs {b[0]}", len(a[1])
    if a[1] != b[1]:
        only_a = [r for r in a[1] if r not in set(b[1])][:3]
        only_b = [r for r in b[1] if r not in set(a[1])][:3]
        return f"rows {len(a[1])} vs {len(b[1])}; {a[0]}; spark only {only_a}; sql only {only_b}", len(a[1])
    return None, len(a[1])


def main():
    import __spark_entry__ as entry
    from turnstile.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, con = local_session(), duck(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in sqls:
                diff, n = differences(spark, con, queries[name], sqls[name], sf)
            else:
                n = len(queries[name](spark, sf).collect())
                diff = None
        except Exception as e:  # report and go on
            diff, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += diff is not None
        kind = "" if name in sqls else " (no sql)"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name}{kind} rows={n} {time.time() - t:.2f}s {diff or ''}", flush=True)
    print("failed:", bad, "sql without query:", sorted(set(sqls) - set(queries)))


if __name__ == "__main__":
    main()
