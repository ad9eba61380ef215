"""Run queries against their SQL: ``python tests/oracle_check.py <sf> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if v is None:
            return "~"
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got, got_columns = normal([tuple(r) for r in df.collect()], df.columns)
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{took:6.1f}s rows={len(got)} (no SQL)"
    start = time.time()
    cursor = con.execute(sql)
    want, want_columns = normal(cursor.fetchall(), [d[0] for d in cursor.description])
    sql_took = time.time() - start
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return False, f"rows {len(got)} vs {len(want)}, {len(bad)} differ: {bad[:2]}"
    return True, f"{took:6.1f}s (sql {sql_took:5.1f}s) rows={len(got)}"


if __name__ == "__main__":
    from plexlake.plans.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names or entry.queries():
        try:
            good, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if good else "FAIL", name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
