"""Run registered queries against DuckDB: ``python -m harness.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from harness.registry import ORACLE, QUERIES, TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "" if v is None else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, name: str) -> tuple[int, str | None]:
    """(row count, what differs). Values are compared exactly, as text."""
    df = QUERIES[name](spark, sf_dir)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return len(got), f"columns {got_names} != {want_names}"
    if got != want:
        extra = sorted(set(got) - set(want))[:2]
        missing = sorted(set(want) - set(got))[:2]
        return len(got), f"rows {len(got)} vs {len(want)}; only Spark {extra}; only DuckDB {missing}"
    return len(got), None


def main() -> int:
    from vitrine.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            n, problem = differences(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
