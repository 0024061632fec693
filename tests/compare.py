"""Run registered queries next to their SQL counterparts and compare the results.

python tests/compare.py [sf_dir] [name prefix ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_plain(x) for x in v])
    try:
        f = float(v)
    except (TypeError, ValueError):
        return str(v)
    if math.isnan(f):
        return "nan"
    return f"{f + 0.0:.10g}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, build, sql):
    df = build(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got[1]), None
    result = con.execute(sql)
    want = normal([d[0] for d in result.description], result.fetchall())
    if got == want:
        return len(got[1]), ""
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}"
    only_got = [r for r in got[1] if r not in set(want[1])][:3]
    only_want = [r for r in want[1] if r not in set(got[1])][:3]
    return len(got[1]), f"{got[0]}: {len(got[1])} vs {len(want[1])} rows; spark {only_got}; sql {only_want}"


def main():
    from __spark_entry__ import oracle_sql, queries

    from bandlore.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, con, sql = build_session(8), connect(sf_dir), oracle_sql()
    bad = 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, con, sf_dir, name, build, sql.get(name))
        except Exception as err:  # noqa: BLE001
            rows, problem = -1, f"{type(err).__name__}: {str(err)[:700]}"
        bad += bool(problem)
        state = "rows only" if problem is None else "ok" if not problem else "BAD " + problem
        print(f"{name:40s} {rows:7d} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
