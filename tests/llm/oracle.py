"""Comparison of registered queries with their DuckDB SQL."""

import duckdb

from deckspark.llm.queries import ORACLES, QUERIES


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def assert_equals_sql(spark, name, sf, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name])
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())
