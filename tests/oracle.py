"""Compares a query with its DuckDB twin."""

import os

import duckdb


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    text = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in at) for r in rows)


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    r = con.sql(sql)
    return sorted(r.columns), rows_of(r.columns, r.fetchall())


def check(spark, query, sql: str, sf_dir: str):
    df = query(spark, sf_dir)
    columns, want = oracle_rows(sql, sf_dir)
    assert sorted(df.columns) == columns
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want)
    assert got == want
