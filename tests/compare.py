"""Compare every registered query with its SQL on DuckDB.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def difference(spark, con, build, sql: str, sf_dir: str) -> str:
    """Empty when both sides hold the same rows under the same column names."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    frame = build(spark, sf_dir)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    order = sorted(names)
    expected = Counter(tuple(dict(zip(names, row))[c] for c in order) for row in result.fetchall())
    actual = Counter(tuple(row) for row in frame.select(*[f"`{c}`" for c in order]).collect())
    if actual == expected:
        return "" if actual else "both empty"
    extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return f"{sum(actual.values())} rows against {sum(expected.values())}; extra {extra}; missing {missing}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pitbars.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    wanted = sys.argv[2:] or list(queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            verdict = difference(spark, con, queries()[name], sql[name], sf_dir)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(verdict)
        print(f"{'ok  ' if not verdict else 'FAIL'} {name} {time.time() - start:.1f}s {verdict[:1500]}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
