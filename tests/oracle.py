"""Run queries and their SQL side by side: ``python tests/oracle.py [sf] [name ...]``."""

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, build, sql):
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    cursor = con.execute(sql)
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(different)} rows differ, first {str(different[0])[:600]}" if different else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tarweave.session import local_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    session = local_session("oracle", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    duck, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for query, fn in queries().items():
        if sys.argv[2:] and query not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(session, duck, sf_dir, query, fn, sqls.get(query))
        except Exception as caught:
            problem = f"{type(caught).__name__}: {str(caught)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {query} {problem or ''}", flush=True)
    sys.exit(bad > 0)
