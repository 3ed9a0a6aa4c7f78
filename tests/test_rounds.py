import pytest
from pyspark.sql import functions as F

from deckspark.operators import cards as CD
from deckspark.operators import checks as C
from deckspark.operators import udf as U
from deckspark.plans import deck_jobs as DJ
from deckspark.streaming import incremental as I


def test_retry_until_nothing_fails(spark):
    units = spark.createDataFrame([(i,) for i in range(6)], "u int")
    asked = []

    def attempt(rows, r):
        asked.append(rows.count())
        ok = F.when(F.col("u") == 5, F.lit(None).cast("boolean") if r < 2 else F.lit(True)).otherwise(F.col("u") <= 2 * r)
        return rows.withColumn("ok", ok).withColumn("got", F.concat(F.lit("r"), F.lit(str(r))))

    done, left = I.retry_rounds(units, attempt)
    assert sorted(tuple(r) for r in done.collect()) == [(0, "r0", 0), (1, "r1", 1), (2, "r1", 1), (3, "r2", 2), (4, "r2", 2), (5, "r2", 2)]
    assert left.count() == 0 and asked == [6, 5, 3]
    done, left = I.retry_rounds(units, attempt, rounds=2)
    assert done.count() == 3 and sorted(r.u for r in left.collect()) == [3, 4, 5]


def test_retry_edges(spark):
    units = spark.createDataFrame([(1,)], "u int")
    never = lambda rows, r: rows.withColumn("ok", F.lit(False))
    with pytest.raises(ValueError):
        I.retry_rounds(units, never)
    done, left = I.retry_rounds(units, never, rounds=3)  # goes on to its limit
    assert done.count() == 0 and left.count() == 1 and done.columns == ["u", "round"]
    done, left = I.retry_rounds(units.limit(0), never)
    assert done.count() == 0 and left.count() == 0


def test_iterate_for_a_number_of_rounds(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, v string")
    pending = lambda d: d.where("v is null")
    calls = []

    def step(d, r):
        calls.append(r)
        return d.withColumn("v", F.when((F.col("i") == 1) & F.lit(r == 2), "late").otherwise(F.col("v")))

    out = I.iterate(df, step, pending, rounds=4)
    assert calls == [0, 1, 2, 3] and {r.i: r.v for r in out.collect()} == {1: "late", 2: None}
    with pytest.raises(ValueError):
        I.iterate(df, step, pending)


def test_reworked_rows_are_merged_back(spark):
    deck = spark.createDataFrame([(1, "a", "good a"), (2, "b", "bad"), (3, "c", None), (4, "d", "bad"), (None, "e", "bad")], "idx int, word string, sentence string")
    judge = lambda d: d.withColumn("good", F.col("sentence").startswith("good"))

    def regenerate(rows, r):
        assert rows.columns == ["idx", "word"]
        ok = F.coalesce(F.col("idx"), F.lit(0)) % 3 == r
        return rows.withColumn("sentence", F.when(ok, F.concat(F.lit("good "), "word")).otherwise("bad"))

    got = {r.word: (r.idx, r.sentence, r.good) for r in DJ.rework(deck, judge, regenerate, ["idx", "word"], rounds=2).collect()}
    assert got == {"a": (1, "good a", True), "b": (2, None, False), "c": (3, "good c", True), "d": (4, "good d", True), "e": (None, "good e", True)}
    assert DJ.rework(deck, judge, regenerate, ["idx", "word"]).where("good").count() == 5


def test_left_over_placeholders_fail(spark):
    df = spark.createDataFrame([("x", "y"), ("{{zz}}", "y")], "a string, b string")
    assert [r.rendered for r in CD.render_template(df, "{{a}}-{{zz}}", ["a"]).collect()] == ["x-{{zz}}", "{{zz}}-{{zz}}"]
    with pytest.raises(ValueError, match="{{zz}}"):
        CD.render_template(df, "{{a}}-{{zz}}", ["a"], strict=True)
    strict = CD.render_template(df, "{{a}}-{{b}}", ["a", "b"], strict=True)
    assert strict.where("a = 'x'").first().rendered == "x-y"
    with pytest.raises(Exception, match="zz"):
        strict.collect()


def test_equal_ranks_have_consecutive_indices(spark):
    rows = [(1, 5), (2, 5), (4, 5), (5, 6), (9, 7), (10, 6), (11, None), (12, 6), (13, 6)]
    df = spark.createDataFrame(rows, "idx int, rank int").repartition(3)
    got = sorted(tuple(r) for r in C.check_rank_order(df, "idx", "rank", consecutive=True).collect())
    assert got == [(4, 5, 5, 2), (10, 6, 7, 9)]
    assert [tuple(r) for r in C.check_rank_order(df, "idx", "rank").collect()] == [(10, 6, 7)]


def test_row_functions():
    assert list(U.wrap_words("aa bb  cc ddddddd e", 5)) == ["aa bb", " cc", "ddddddd", "e"] and list(U.wrap_words("", 5)) == [""]
    assert U.without_accents("Ärger naïve façade ß") == "Arger naive facade ß"
    assert round(U.jaro("MARTHA", "MARHTA"), 4) == 0.9444 and U.jaro("", "") == 1.0 and U.jaro("a", "b") == 0.0


def test_groups_of_any_size(spark):
    import pandas as pd

    df = spark.range(25_000).selectExpr("if(id % 5 = 0, null, 'hot') as k", "id as v").repartition(3)
    schema = "k string, v long, n long"
    seen = []

    def fold(g, n):
        seen.append(len(g))
        return pd.DataFrame({"k": [g["k"].iloc[0]], "v": [int(g["v"].max())], "n": [int(n)]})

    out = U.apply_groups(df, "k", lambda g: fold(g, g["n"].sum()), schema, lambda g: fold(g, len(g)), schema)
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("hot", 24_999, 20_000), (None, 24_995, 5_000)]


def test_many_groups_in_a_call(spark):
    """As one by one: few calls, whole groups, null keys, integers no float holds."""
    big = 2**60
    df = spark.range(30_000).selectExpr(f"if(id % 7 = 0, null, if(id < 12000, 1, {big} + id % 9001)) as k", "id as v").repartition(3)
    calls = spark.sparkContext.accumulator(0)

    def fold(g):
        calls.add(1)
        return g.groupby("k", dropna=False, sort=False).agg(v=("v", "max"), n=("n", "sum")).reset_index()

    schema = "k long, v long, n long"
    out = U.apply_groups(df, "k", fold, schema, lambda g: fold(g.assign(n=1)), schema, many=True)
    want = df.selectExpr("k", "v").groupBy("k").agg({"v": "max", "*": "count"}).select("k", "max(v)", "count(1)")
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted((tuple(r) for r in want.collect()), key=str)
    assert calls.value < 100


def test_group_function_takes_few_calls(spark, tmp_path):
    from pyspark.sql import functions as F

    import __spark_entry__ as E

    li = spark.range(40_000).select((F.col("id") % 20_000).alias("l_partkey"), F.when(F.col("id") % 3 > 0, F.chr(65 + F.col("id") % 5)).alias("l_returnflag"))
    li = li.unionByName(spark.createDataFrame([(None, "N"), (None, "A"), (7, "N")], li.schema))
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    flags = F.array_join(F.array_sort(F.collect_set("l_returnflag")), ";")
    want = li.groupBy("l_partkey").agg(F.when(flags != "", flags).alias("flags"), F.count("*").alias("n"))
    got = E.queries()["udf03_apply_groups"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r) for r in want.collect()), key=str)
