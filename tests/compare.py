"""Run registered queries against their DuckDB twins: python tests/compare.py [sf] [name-prefix ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events".split()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) or "" for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name, query, sql):
    """None when equal, else a short description of the difference."""
    frame = query(spark, folder)
    got, names = [tuple(r) for r in frame.collect()], frame.columns
    if sql is None:
        return f"no twin, {len(got)} rows"
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns differ: {sorted(set(names) ^ set(want_names))}"
    a, b = rows_of(names, got), rows_of(want_names, want)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} / {len(b)}"
    for left, right in zip(a, b):
        if left != right:
            cols = sorted(names)
            return "; ".join(f"{c}: {x!r} / {y!r}" for c, x, y in zip(cols, left, right) if x != y)[:600]
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from forecourt.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            result = compare(spark, con, folder, name, query, sql.get(name))
        except Exception as error:  # report and go on
            result = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        bad += bool(result) and "no twin" not in result
        print(f"{'ok  ' if not result else 'DIFF'} {name} {time.time() - t:.2f}s {result or ''}", flush=True)
    print("failures:", bad)
