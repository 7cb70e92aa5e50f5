"""Compare every registered query with its SQL on one scale of the test tables."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (2, f"{value:.9g}")
    if isinstance(value, int):
        return (2, f"{float(value):.9g}")
    return (3, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same names and rows."""
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    right = _rows([d[0] for d in found.description], found.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference: {str(a)[:400]} against {str(b)[:400]}"
    return None if left[1] else "no rows"


def main(sf_dir: str, names: list[str]) -> int:
    from entitylake.plans.catalog import CHECKS, QUERIES
    from entitylake.session import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in CHECKS:
                problem = difference(df, con, CHECKS[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
