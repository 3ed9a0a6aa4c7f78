"""Every registered query with an oracle must equal its DuckDB SQL on the
small driver tables (order-insensitive, columns matched by name)."""

import math
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQLS = E.oracle_sql()
QUERIES = E.queries()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return v.quantize(Decimal("0.000001"))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_a_builder():
    assert set(SQLS) <= set(QUERIES)
    assert len(QUERIES) >= 240


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.limit(5).count() == 5


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(SQLS[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == exp


# tests/llm covers the queries of the llm subpackage
OWN = [n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", sorted(set(OWN) - set(SQLS)))
def test_rows_only_queries_give_rows(spark, sf, name):
    """Their contents are tested against brute force elsewhere."""
    df = QUERIES[name](spark, sf)
    assert df.count() > 0 and len(df.columns) > 0
