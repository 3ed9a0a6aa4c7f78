import os
from decimal import Decimal

import pytest

from deckspark.operators import joins as J
from deckspark.session import scratch_path
from deckspark.sources import stored as ST


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def files(path):
    out = {}
    for folder, _, names in os.walk(local(path)):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), set()).add(n)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def deck(spark):
    return spark.range(1000).selectExpr("cast(id * 3 as decimal(18,6)) as idx", "concat('w', id) as word", "id as n").repartition(4)


def test_only_touched_ranges_are_rewritten(spark, deck):
    path = scratch_path(spark, "t-store")
    ST.create_store(deck, path, "idx", rows=100)
    before = files(path)
    assert len(before) == 10 and rows(ST.read_store(spark, path)) == rows(deck)
    patch = spark.createDataFrame([(Decimal(i), f"new{i}", None) for i in (900, 901, 903, 1190)], "idx decimal(18,6), word string, n long")
    touched = ST.upsert_store(spark, path, patch, "idx", rows=100)
    after = files(path)
    assert touched == ["from 900.000000"]
    changed = {f for f in after if after[f] != before.get(f)}
    assert len(changed) == 1 and len(after) == 10
    want = rows(J.upsert(deck, patch, "idx"))
    assert rows(ST.read_store(spark, path)) == want
    assert ST.upsert_store(spark, path, patch, "idx", rows=100) == touched and rows(ST.read_store(spark, path)) == want


def test_patch_adds_nothing(spark, deck):
    path = scratch_path(spark, "t-store")
    ST.create_store(deck, path, "idx", rows=300)
    patch = spark.createDataFrame([(Decimal(3), None, 5), (Decimal(4), "x", 1)], "idx decimal(18,6), word string, n long")
    ST.patch_store(spark, path, patch, "idx", rows=300)
    assert rows(ST.read_store(spark, path)) == rows(J.patch_rows(deck, patch, "idx", strip_strings=False))
    assert ST.patch_store(spark, path, patch.limit(0), "idx") == []


def test_edges_and_growth(spark):
    """Smaller and larger indices than any stored, null ones, equal ones, and
    ranges that grow beyond twice their rows."""
    path = scratch_path(spark, "t-store")
    make = lambda x: spark.createDataFrame(x, "idx double, v string")
    first = [(float(i), "a") for i in range(10, 50)] + [(None, "none")] + [(10.0, "again")] * 5
    ST.store_or_create(spark, path, make(first), "idx", rows=10)
    assert rows(ST.read_store(spark, path)) == rows(make(first))
    more = [(float(i) / 4, "b") for i in range(200, 400)] + [(-5.0, "low"), (None, "null now")]
    ST.store_or_create(spark, path, make(more), "idx", rows=10)
    old = [r for r in first if r[0] not in {m[0] for m in more}]
    assert rows(ST.read_store(spark, path)) == rows(make(old + more))
    assert len(files(path)) > 15
    # every index lies in the range that its folder names
    spans = spark.read.parquet(path).where("index_range <> 'null'").groupBy("index_range").agg({"idx": "max"}).collect()
    starts = sorted((float(r[0][5:]), r[1]) for r in spans)
    assert all(top < nxt for (_, top), (nxt, _) in zip(starts, starts[1:]))


def test_an_empty_deck(spark):
    path = scratch_path(spark, "t-store")
    one = spark.createDataFrame([("b", 1), ("a", 2)], "idx string, v int")
    ST.store_or_create(spark, path, one, "idx")
    ST.upsert_store(spark, path, spark.createDataFrame([("c", 3), ("a", 9)], "idx string, v int"), "idx")
    assert rows(ST.read_store(spark, path)) == [("a", 9), ("b", 1), ("c", 3)]
