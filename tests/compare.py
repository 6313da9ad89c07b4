"""Run a registered query and its oracle on the same tables and compare all rows."""

from __future__ import annotations

import glob
import os

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """``(equal, message, row count)``."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} <> {want_cols}", len(got)
    if len(got) != len(want):
        return False, f"rows {len(got)} <> {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} rows differ, first: {str(bad[0])[:1500]}", len(got)
    return True, "", len(got)
