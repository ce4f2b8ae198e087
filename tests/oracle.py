"""Compare registered queries with their SQL on one scale factor.

``python tests/oracle.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return f"{type(value).__name__}:{value!r}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql):
    """None if equal, else a description of the difference."""
    df = query(spark, sf_dir)
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    extra, lacking = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} vs {len(want)}; only Spark {extra[:3]}; only SQL {lacking[:3]}"


def main(argv):
    from conftest import make_session
    from fareway.registry.oracles import all_oracles
    from fareway.registry.queries import all_queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sqls = all_queries(), all_oracles()
    assert not set(sqls) - set(queries), set(sqls) - set(queries)
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, queries[name], sqls[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    sys.exit(main(sys.argv[1:]))
