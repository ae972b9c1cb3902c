"""Runs a query and its SQL in DuckDB over the same tables and compares the rows, whatever their order."""

import decimal
import math
import os

import duckdb


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return float(f"{v:.10g}") if isinstance(v, float) else v


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want
