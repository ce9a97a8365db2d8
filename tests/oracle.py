"""Run registered queries and their SQL checks side by side.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def counted(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    ours = counted(df.columns, df.collect())
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = counted(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{ours.total()} rows, check has {theirs.total()}; "
            f"only here {extra.most_common(2)}, only in check {missing.most_common(2)}"
        )
    return None if ours else "no rows"


if __name__ == "__main__":
    from conftest import new_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, con = new_session(), connect(sf_dir)
    checks = entry.oracle_sql()
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.monotonic()
        try:
            problem = compare(session, con, name, run, checks[name], sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.monotonic() - start:6.1f}s {name} {problem or ''}", flush=True)
