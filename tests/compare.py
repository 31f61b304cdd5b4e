"""Run registered queries and their SQL twins side by side.

    python -m tests.compare 0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple("\0null" if r[i] is None else _norm(r[i]) for i in order) for r in data)


def check(spark, con, folder: str, name: str, fn, sql: str | None) -> str:
    """Empty string if both sides agree, else what differs."""
    df = fn(spark, folder)
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    want_names, want = rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if len(got) != len(want):
        return f"row count {len(got)} / {len(want)}"
    if not got:
        return "no rows"
    diff = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(diff)} of {len(got)} rows differ, first {diff[0]}" if diff else ""


def main():
    import __spark_entry__ as E
    from tallybook.session import get_spark, release

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    qs, oracle, bad = E.queries(), E.oracle_sql(), 0
    for name in sys.argv[2:] or qs:
        t0 = time.time()
        try:
            msg = check(spark, con, folder, name, qs[name], oracle.get(name))
        except Exception as e:
            msg = f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"
        bad += bool(msg)
        release(spark)
        kind = "O" if name in oracle else "R"
        print(f"{'FAIL' if msg else 'ok  '} {kind} {time.time() - t0:6.1f}s {name} {msg}", flush=True)
    print("failed", bad)


if __name__ == "__main__":
    main()
