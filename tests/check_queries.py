"""Compare registered queries with their oracle SQL on a data folder: ``check_queries.py [folder] [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf, name, fn, sql):
    start = time.time()
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return f"ROWS   {len(got):7d} {spent:6.2f}s"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"COLS   {sorted(df.columns)} vs {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return f"OK     {len(a):7d} {spent:6.2f}s"
    only_a = [x for x in a if x not in set(b)][:2]
    only_b = [x for x in b if x not in set(a)][:2]
    return f"DIFF   {len(a)} vs {len(b)} rows\n   spark : {only_a}\n   oracle: {only_b}"


def main() -> int:
    import duckdb

    import __spark_entry__ as entry
    from sievelight.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        try:
            line = compare(spark, con, sf, name, fn, oracles.get(name))
        except Exception as exc:  # report and go on
            line = f"ERROR  {type(exc).__name__}: {str(exc)[:300]}"
        bad += not line.startswith(("OK", "ROWS"))
        print(f"{name:32s} {line}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
