import random

import pandas as pd
from pyspark.sql import functions as F

from deckspark.operators import window as W


def test_running_sum_matches_pandas_across_ranges(spark):
    rng = random.Random(5)
    rows = []
    for k in ["hot"] * 3000 + [f"k{i}" for i in range(200)]:
        rows.append((k, rng.randint(0, 10_000_000), rng.randint(1, 9)))
    df = spark.createDataFrame(rows, "k string, o long, v long").dropDuplicates(["k", "o"])
    out = W.running_sum(df, ["k"], ["o"], "v", "cum").toPandas()
    pdf = df.toPandas().sort_values(["k", "o"])
    pdf["cum"] = pdf.groupby("k")["v"].cumsum()
    m = out.merge(pdf, on=["k", "o", "v"], suffixes=("", "_pd"))
    assert len(m) == len(pdf)
    assert (m["cum"] == m["cum_pd"]).all()


def test_number_rows_global_exclusive(spark):
    df = spark.range(0, 5000).withColumn("o", (F.col("id") * 7919) % 5003)
    out = W.number_rows(df, [], ["o"], "rn").toPandas().sort_values("o")
    assert out["rn"].tolist() == list(range(1, len(out) + 1))
    ex = W.running_sum(df, [], ["o"], F.lit(1).cast("bigint"), "before", inclusive=False).toPandas()
    assert sorted(ex["before"].tolist()) == list(range(len(out)))


def test_with_context_edges_blank(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "z")], "t int, p int, s string")
    out = {(r.t, r.p): (r.s_prev, r.s_next) for r in W.with_context(df, "t", "p", ["s"]).collect()}
    assert out == {(1, 1): ("", "b"), (1, 2): ("a", "c"), (1, 3): ("b", ""), (2, 1): ("", "")}


def test_with_margins(spark):
    df = spark.createDataFrame([(1, p, f"l{p}") for p in range(1, 6)], "t int, p int, s string")
    out = {r.p: (r.before, r.after) for r in W.with_margins(df, "t", "p", "s", 2).collect()}
    assert out[1] == (["", ""], ["l2", "l3"])
    assert out[3] == (["l1", "l2"], ["l4", "l5"])
    assert out[5] == (["l3", "l4"], ["", ""])


def test_missing_meanings(spark):
    from decimal import Decimal

    deck = spark.createDataFrame(
        [(Decimal("3"), "go"), (Decimal("3.001"), "walk"), (Decimal("4"), "eat")], "idx decimal(18,6), translation string"
    )
    wanted = spark.createDataFrame([(3, "go"), (3, "run"), (3, "move"), (4, "dine")], "block long, translation string")
    out = {(r.block, r.translation): r.new_idx for r in W.missing_meanings(deck, wanted).collect()}
    assert out == {(3, "move"): Decimal("3.002"), (3, "run"): Decimal("3.003"), (4, "dine"): Decimal("4.001")}


def test_first_per_key_and_suffix_on_a_hot_key(spark):
    """One key holding most rows: results must equal the plain definitions."""
    from decimal import Decimal

    from deckspark.operators import agg as G

    rows = [("hot", i, f"v{i % 97}") for i in range(6000)] + [(f"k{i}", i, "x") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    first = {r.k: r.o for r in G.first_per_key(df, "k", ["o"]).collect()}
    assert first["hot"] == 0 and first["k7"] == 7
    last = {r.k: r.o for r in G.last_per_key(df, "k", ["o"]).collect()}
    assert last["hot"] == 5999
    idx = df.withColumn("idx", F.lit(Decimal(1)).cast("decimal(18,6)"))
    out = W.suffix_occurrences(idx.where(F.col("k") == "hot"), "idx", ["o"], "0.0001")
    got = sorted(r.idx for r in out.collect())
    assert got == [Decimal(1) + Decimal(i) / 10000 for i in range(6000)]


def test_lookup_keeps_all_rows(spark):
    from deckspark.operators.joins import lookup

    big = spark.range(0, 50).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    facts = spark.range(0, 200).withColumn("k", F.col("id") % 60)
    out = lookup(facts, "k", big, "k", ["v"])
    assert out.count() == 200 and out.where(F.col("v") == F.col("k") * 2).count() == facts.where("k < 50").count()


def test_hot_key_is_spread_over_tasks(spark):
    """A key holding a third of all rows, with dense order values: sampled
    ranges put its rows into several of them, where a plain window uses one."""
    hot = spark.range(0, 30000).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    rest = spark.range(0, 60000).select(F.concat(F.lit("k"), (F.col("id") % 600).cast("string")).alias("k"), F.col("id").alias("o"))
    df = hot.unionByName(rest)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = W._ranged(df, ["k"], ["o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = {r["__p"]: r["count"] for r in ranged.groupBy("__p").count().collect()}
    hot_in = ranged.where(F.col("k") == "hot").select("__p").distinct().count()
    assert hot_in >= 2 and max(sizes.values()) < 45000
    out = W.number_rows(df, ["k"], ["o"], "rn")
    # correctness of the numbering for the hot key
    got = [r.rn for r in out.where(F.col("k") == "hot").orderBy("o").select("rn").collect()]
    assert got == list(range(1, 30001))


def test_null_groups_and_null_orders_are_kept(spark):
    rows = [(None, 1, 5), (None, 2, 7), ("a", None, 1), ("a", 3, 2), ("b", 1, None), (None, None, 4)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.cum for r in W.running_sum(df, ["k"], ["o"], "v", "cum").collect()}
    assert got == {(None, None): 4, (None, 1): 9, (None, 2): 16, ("a", None): 1, ("a", 3): 3, ("b", 1): None}
    rn = {(r.k, r.o): r.rn for r in W.number_rows(df, ["k"], ["o"], "rn").collect()}
    assert rn == {(None, None): 1, (None, 1): 2, (None, 2): 3, ("a", None): 1, ("a", 3): 2, ("b", 1): 1}
    flat = W.number_rows(df, [], ["k", "o"], "rn").collect()
    assert sorted(r.rn for r in flat) == [1, 2, 3, 4, 5, 6]
    assert W.number_rows(df.limit(0), [], ["o"], "rn").count() == 0


def test_the_input_is_read_once(spark, sf):
    """The numbering reads its input in one scan; what follows reads the
    table written from it."""
    from deckspark.plans.views import v_line

    plan = W.number_rows(v_line(spark, sf), [], ["doc_id", "pos"], "rn")._jdf.queryExecution().optimizedPlan().toString()
    assert "documents.parquet" not in plan


def test_sums_over_many_ranges(spark):
    """Forced into many ranges: hot and small groups, ties in the key."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000).select((F.col("id") % 7 % 3).alias("k"), ((F.col("id") * 7919) % 4001).alias("o"), (F.col("id") % 10).alias("v"))
        out = W.running_sum(df, ["k"], ["o"], "v", "cum", inclusive=False).toPandas().sort_values(["k", "o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (out["cum"] == out.groupby("k")["v"].cumsum() - out["v"]).all() and len(out) == 4000
