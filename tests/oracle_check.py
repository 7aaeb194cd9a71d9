"""Compare registered queries with their DuckDB SQL.

Run as ``python tests/oracle_check.py [sf_dir] [query …]`` for a report.
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a description of the first difference."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = _rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"got  {g}\n      want {w}"
    return None


if __name__ == "__main__":
    from tests.conftest import make_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    session, con = make_session(), duck(sf_dir)
    for name in chosen:
        start = time.time()
        try:
            diff = compare(session, con, name, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # report and go on
            diff = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
