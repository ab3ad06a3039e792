"""Compare registered queries with their SQL oracle. Run: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(name, df, con, sql):
    """None if both agree, else a short account of the difference."""
    rel = con.execute(sql)
    cols, rows = canonical([d[0] for d in rel.description], rel.fetchall())
    scols, srows = canonical(df.columns, [tuple(r) for r in df.collect()])
    if cols != scols:
        return f"columns {scols} != {cols}"
    if len(rows) != len(srows):
        return f"{len(srows)} rows != {len(rows)}"
    for a, b in zip(srows, rows):
        if a != b:
            return f"spark {a} != sql {b}"
    return None if rows else "empty result"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from scrimtally.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in sql:
                problem = compare(name, query(spark, sf_dir), con, sql[name])
            else:
                problem = None if query(spark, sf_dir).count() else "empty result"
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differences")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
