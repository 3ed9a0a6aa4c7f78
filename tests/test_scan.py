import random

import pytest
from pyspark.sql import functions as F

from deckspark.operators.scan import FIRST, LAST, MAX, MIN, SUM, Associative, asof_join, interval_join, prefix_scan


def rows_of(n, seed, keys):
    rnd = random.Random(seed)
    return [(rnd.choice(keys), o, rnd.choice([None, rnd.randint(-9, 9)])) for o in rnd.sample(range(10 * n), n)]


@pytest.mark.parametrize("inclusive", [True, False])
def test_scans_match_a_walk(spark, inclusive):
    """A hot key over several ranges, null keys, null values."""
    rows = rows_of(2500, 1, ["hot"] * 30 + ["a", "b", None])
    df = spark.createDataFrame(rows, "k string, o long, v long")
    pick = {"s": SUM, "top": MAX, "low": MIN, "last": LAST, "first": FIRST}
    # composition of maps x -> m * x + c modulo a prime does not commute
    p = 10007
    step = F.when(F.col("v").isNotNull(), F.struct((F.col("v") + 20).alias("m"), F.col("o").alias("c")))
    maps = Associative(lambda a, b: F.struct((a["m"] * b["m"] % p).alias("m"), ((a["c"] * b["m"] + b["c"]) % p).alias("c")))
    out = prefix_scan(df, ["k"], ["o"], {**{n: ("v", f) for n, f in pick.items()}, "map": (step, maps)}, inclusive)
    assert out.columns == ["k", "o", "v", *pick, "map"]
    got = {r.o: tuple(r)[2:] for r in out.collect()}
    assert len(got) == len(rows)
    walk = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        seen, state = walk.setdefault(k, ([], None))
        before = (list(seen), state)
        if v is not None:
            seen.append(v)
            m, c = v + 20, o
            state = (m, c) if state is None else (state[0] * m % p, (state[1] * m + c) % p)
            walk[k] = (seen, state)
        vals, now = (seen, state) if inclusive else before
        want = (sum(vals), max(vals), min(vals), vals[-1], vals[0]) if vals else (None,) * 5
        assert got[o][:6] == (v, *want)
        assert got[o][6] == (None if now is None else now)


def test_scan_without_keys_replaces_columns(spark):
    df = spark.createDataFrame([(i, (i * 7) % 11) for i in range(300)], "o long, v long").repartition(5)
    got = prefix_scan(df, [], ["o"], {"v": ("v", MAX)}).orderBy("o").collect()
    assert [r.v for r in got] == [max((j * 7) % 11 for j in range(i + 1)) for i in range(300)]
    assert prefix_scan(df.limit(0), [], ["o"], {"v": ("v", MAX), "m": ("v", Associative(lambda a, b: a + b))}).count() == 0


def asof_by_hand(left, right, direction, exact):
    out = []
    for i, k, t in left:
        fits = [(u, j) for j, m, u in right if m == k and u is not None and t is not None and (u < t if direction == "backward" else u > t) | (exact and u == t)]
        out.append((i, (max if direction == "backward" else min)(fits)[1] if fits else None))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
def test_asof_join(spark, direction, exact):
    rnd = random.Random(4)
    one = lambda n: [(i, rnd.choice(["hot", "hot", "hot", "x", None]), rnd.choice([None, *range(60)])) for i in range(n)]
    left, right = one(500), one(200)
    a, b = (spark.createDataFrame(x, "id long, k string, t long").repartition(3) for x in (left, right))
    out = asof_join(a, b, "t", by="k", direction=direction, exact=exact, order="id")
    assert out.columns == ["id", "k", "t", "id_r", "t_r"]
    assert sorted((r.id, r.id_r) for r in out.collect()) == asof_by_hand(left, right, direction, exact)


def test_asof_join_tolerance_and_no_keys(spark):
    a = spark.createDataFrame([(1, 10), (2, 17), (3, 30)], "id long, t long")
    b = spark.createDataFrame([(7, 9), (8, 12)], "id long, t long")
    got = {r.id: r.id_r for r in asof_join(a, b, "t", tolerance=F.lit(5)).collect()}
    assert got == {1: 7, 2: 8, 3: None}
    assert {r.id_r for r in asof_join(a, b.limit(0), "t").collect()} == {None}
    with pytest.raises(ValueError):
        asof_join(a, b, "t", direction="sideways")


def test_interval_join_matches_all_pairs(spark):
    rnd = random.Random(6)
    points = [(i, rnd.choice(["a", "a", None]), rnd.choice([None, 5, rnd.randrange(1000)])) for i in range(400)]
    spans = [(i, rnd.choice(["a", "b", None]), lo, lo + rnd.choice([0, 1, 3, 40, -2])) for i, lo in enumerate(rnd.choices(range(1000), k=150))]
    spans += [(900, "a", -5, 5000), (901, None, None, 7), (902, "a", 3, None)]
    a = spark.createDataFrame(points, "pid long, k string, x long").repartition(3)
    b = spark.createDataFrame(spans, "sid long, k string, lo long, hi long").repartition(2)
    want = sorted((p, s) for p, k, x in points for s, m, lo, hi in spans if k == m and None not in (x, lo, hi) and lo <= x < hi)
    out = interval_join(a, b, "x", "lo", "hi", by="k")
    assert out.columns == ["pid", "k", "x", "sid", "lo", "hi"]
    assert sorted((r.pid, r.sid) for r in out.collect()) == want
    every = interval_join(a.drop("k"), b.drop("k"), "x", "lo", "hi").count()
    assert every == sum(lo <= x < hi for _, _, x in points for _, _, lo, hi in spans if None not in (x, lo, hi))
    with pytest.raises(ValueError):
        interval_join(a, b.withColumnRenamed("sid", "pid"), "x", "lo", "hi", by="k")
    assert interval_join(a, b.limit(0), "x", "lo", "hi", by="k").count() == 0


def test_interval_join_is_linear_in_a_hot_spot(spark):
    """20,000 points and 20,000 intervals in one place that do not meet, and
    one interval over the whole axis: bins would pair all of them."""
    points = spark.range(20_000).select(F.col("id").alias("pid"), F.lit(1000.5).alias("x"))
    spans = spark.range(20_000).select(F.col("id").alias("sid"), (F.lit(1000.5) + (F.col("id") + 1) / 1e6).alias("lo"), F.lit(1001.0).alias("hi"))
    spans = spans.unionByName(spark.createDataFrame([(-1, 0.0, 1e9)], "sid long, lo double, hi double"))
    out = interval_join(points, spans, "x", "lo", "hi")
    assert out.groupBy("sid").count().collect() == [(-1, 20_000)]
    assert "CartesianProduct" not in plan(out) and "NestedLoop" not in plan(out)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cooldown_flags_of_a_burst(spark):
    """Ten thousand errors of one second: one scan, no join by ranges."""
    from deckspark.streaming.incremental import cooldown_flags

    df = spark.range(20_000).select("id", F.timestamp_micros(F.when(F.col("id") < 15_000, 1_000_000 + F.col("id")).otherwise(F.col("id") * 1000)).alias("ts"), (F.col("id") % 2 == 0).alias("err"))
    df = df.withColumn("err", F.col("err") & (F.col("id") < 15_000))
    out = cooldown_flags(df, "id", "ts", F.col("err"), 15)
    errors = [1_000_000 + i for i in range(0, 15_000, 2)]
    time = lambda i: 1_000_000 + i if i < 15_000 else i * 1000
    assert {r.id: r.cooling for r in out.collect()} == {i: any(e <= time(i) < e + 15_000_000 for e in (errors[0], errors[-1])) for i in range(20_000)}
    assert not any(x in plan(out) for x in ("SortMergeJoin", "ShuffledHashJoin", "Generate", "NestedLoop"))
