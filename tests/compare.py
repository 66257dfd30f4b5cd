"""Run check queries beside DuckDB: python tests/compare.py [folder] [name part ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, int):
        return v
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(body, key=repr)


def differences(spark_df, con, sql):
    left = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right = table([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, first {bad[0]} ({left[0]})"
    return None


def main():
    import __spark_entry__ as driver
    from featloom.session import build_session

    args = sys.argv[1:]
    folder = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    parts = [a for a in args if not a.startswith("/")]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = driver.queries(), driver.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                problem = differences(df, con, sql[name])
                label = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem = None
                label = f"rows {len(df.collect())}"
        except Exception as e:  # report and go on with the next query
            problem, label = e, f"ERROR {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:45s} {time.time() - start:6.2f}s {label}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
