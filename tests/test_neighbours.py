import random

import pytest
from pyspark.sql import functions as F

from deckspark.operators import window as W


def by_hand(rows, before, after):
    groups = {}
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        groups.setdefault(r[0], []).append(r)
    out = []
    for g in groups.values():
        for i, r in enumerate(g):
            at = lambda j: g[j][2] if 0 <= j < len(g) else None
            out.append((*r, [at(i - s) for s in range(1, before + 1)], [at(i + s) for s in range(1, after + 1)], [0 <= i - s for s in range(1, before + 1)]))
    return sorted(out, key=str)


@pytest.mark.parametrize("before,after", [(1, 1), (3, 2), (0, 2), (2, 0)])
@pytest.mark.parametrize("n", [7, 900])
def test_neighbours(spark, n, before, after):
    """A hot key over several ranges, ranges of few rows, null and repeated
    keys, positions and values, rows that repeat as a whole."""
    rnd = random.Random(n)
    rows = [(rnd.choice(["hot"] * 9 + ["a", None]), rnd.choice([None, *range(n // 2 + 1)]), rnd.choice(["x", "y", None, f"v{rnd.randrange(n)}"])) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, p int, v string").repartition(4)
    got = []
    found = W.neighbours(df, ["k"], ["p", "v"], ["v"], before, after, number="nth").collect()
    in_order = sorted(found, key=lambda r: r.nth)
    assert [r.nth for r in in_order] == list(range(1, n + 1))
    assert [(r.k, r.p, r.v) for r in in_order] == sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    for r in found:
        values = [[x and x.v for x in side] for side in (r["__before"], r["__after"])]
        got.append((r.k, r.p, r.v, *values, [x is not None for x in r["__before"]]))
    assert sorted(got, key=str) == by_hand(rows, before, after)


def test_context_keeps_every_row(spark):
    rows = [(1, None, "a"), (1, None, "b"), (1, 1, "c"), (1, 1, "c"), (None, 2, "d")]
    df = spark.createDataFrame(rows, "t int, p int, s string")
    got = sorted((tuple(r) for r in W.with_context(df, "t", "p", ["s"]).collect()), key=str)
    assert got == sorted([(1, None, "a", "", "b"), (1, None, "b", "a", "c"), (1, 1, "c", "b", "c"), (1, 1, "c", "c", ""), (None, 2, "d", "", "")], key=str)
    assert W.with_context(df.limit(0), "t", "p", ["s"]).count() == 0
    margins = W.with_margins(df, "t", "p", "s", 2).where("s = 'b'").first()
    assert (margins.before, margins.after) == (["", "a"], ["c", "c"])


@pytest.mark.parametrize("most,size", [(4096, 8 << 20), (3, 8 << 20), (4096, 40)])
def test_context_of_packs(spark, monkeypatch, most, size):
    """Rows go to their range once, in packs of many rows, few and one."""
    monkeypatch.setattr(W, "PACK_ROWS", most)
    monkeypatch.setattr(W, "PACK_BYTES", size)
    rnd = random.Random(most + size)
    rows = [(rnd.choice(["hot"] * 9 + ["a", "b", None]), rnd.choice([None, *range(150)]), rnd.choice(["x", None, f"v{rnd.randrange(300)}"]), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, p int, v string, other double").repartition(4)
    x = W.with_context(df, "k", "p", ["v"], number="nth")
    found = sorted(x.collect(), key=lambda r: r.nth)
    assert x.columns == ["k", "p", "v", "other", "v_prev", "v_next", "nth"] and [r.nth for r in found] == list(range(1, 301))
    assert [(r.k, r.p, r.v) for r in found] == sorted([r[:3] for r in rows], key=lambda r: tuple((x is not None, x) for x in r))
    assert sorted(r.other for r in found) == sorted(r[3] for r in rows)
    want = [(*r[:3], *[(side and side[0]) or "" for side in r[3:5]]) for r in by_hand([r[:3] for r in rows], 1, 1)]
    assert sorted([(r.k, r.p, r.v, r.v_prev, r.v_next) for r in found], key=str) == sorted(want, key=str)
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [lag(v" not in plan and "Repartition" not in plan  # no shuffle of the rows after their range's


@pytest.mark.parametrize("most", [4096, 3])
@pytest.mark.parametrize("kind", ["string", "int"])
def test_context_with_heads(spark, monkeypatch, most, kind):
    """Keys of no row, of no head and of several, a hot key over the ranges."""
    monkeypatch.setattr(W, "PACK_ROWS", most)
    rnd = random.Random(most)
    rows = [(rnd.choice(["7"] * 9 + ["1", "2", "8", None]), rnd.randrange(200), f"v{rnd.randrange(300)}") for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, p int, v string").repartition(4)
    heads = spark.createDataFrame([("7", "x", 1), ("7", "y", None), ("1", None, 2), ("5", "z", 3), (None, "n", 4), ("8", "w", 5), ("9", "q", 6)], "k string, title string, c int")
    heads = heads.withColumn("k", F.col("k").cast(kind))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else the rows are in one range
    try:
        got = W.with_context(df, "k", "p", ["v"], number="nth", heads=heads)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = W.with_context(df, "k", "p", ["v"], number="nth").join(heads, "k", "left")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r) for r in want.collect()), key=str)
    if kind == "string":
        packs = spark.read.parquet(*got.inputFiles())  # the hot key's head is before several ranges
        assert packs.where(F.get("k", 0) == "7").select(F.shiftright("__c", 33)).distinct().count() > 1
        assert "Join LeftOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert W.with_context(df.limit(0), "k", "p", ["v"], heads=heads).count() == 0
    assert W.with_context(df, "k", "p", ["v"], heads=heads.limit(0)).where("title is null").count() == 300
