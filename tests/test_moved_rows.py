"""Queries and readers that move each row no more often than they must."""
import glob

from pyspark.sql import functions as F

import __spark_entry__ as E
from deckspark.operators import window as W
from deckspark.sources import readers as R
from deckspark.sources import sinks as K


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_notes_of_many_files(spark, tmp_path):
    p = f"{tmp_path}/notes"
    df = spark.range(1000).repartition(5).select(F.concat(F.lit("#"), F.col("id"), F.lit(";<b>")).alias("v"))
    K.write_note_file(df, "v", ["#separator:semicolon", "#html:false"], p)
    files = [open(f).read().split("\n")[:2] for f in glob.glob(f"{p}/part-*")]
    assert len(files) == 5 and all(f == ["#separator:semicolon", "#html:false"] for f in files)
    df = df.select(F.concat(F.lit("x"), "v").alias("v"))
    K.write_note_file(df, "v", ["#separator:semicolon", "#html:false"], p)
    got = sorted(tuple(r) for r in R.read_note_file(spark, p, ["a", "b"]).collect())
    assert got == sorted((f"x#{i}", "&lt;b&gt;") for i in range(1000))


def test_lines_stay_in_their_splits(spark, tmp_path):
    for i, n in enumerate([300, 1, 500]):
        (tmp_path / f"{i}.txt").write_text("".join(f"{i} {k}\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        x = R.read_lines(spark, str(tmp_path))
        want = [f"{i} {k}" for i, n in enumerate([300, 1, 500]) for k in range(n)]
        assert sorted(tuple(r) for r in x.collect()) == list(enumerate(want, 1))
        headless = sorted(tuple(r) for r in R.read_lines(spark, str(tmp_path), skip_header=True).collect())
        assert headless == list(enumerate([w for w in want if not w.endswith(" 0")], 1))
        each = R.read_lines(spark, str(tmp_path), across_files=False)
        assert sorted(tuple(r) for r in each.collect()) == sorted((int(w.split()[1]) + 1, w) for w in want)
        assert "Sort " not in plan(x) and "Repartition" not in plan(x) and "ordered" not in plan(x)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_neighbours_send_rows_as_they_are(spark):
    df = spark.range(300_000).selectExpr("id % 3 as k", "id as p", "cast(id as string) as v").repartition(2)
    got = W.neighbours(df, ["k"], ["p"], ["v"], 1, 1, number="nth")
    bad = got.where(~(F.coalesce(F.get("__before", 0)["v"].cast("long"), F.col("p") - 3) == F.col("p") - 3) | ((F.col("p") < 299_997) & (F.get("__after", 0)["v"].cast("long") != F.col("p") + 3)))
    assert bad.isEmpty() and got.where("nth = 1").first().p == 0
    window = got._jdf.queryExecution().executedPlan().toString().split("Window [lag")[1].split("Exchange")[1]
    assert "named_struct" not in window  # rows reach a chunk without copies of their columns


def test_lines_joined_from_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b  a\nc"), (1, "a d"), (None, "x y"), (2, None), (3, "")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    x = E.queries()["arr02_array_join"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in x.collect()), key=str) == sorted([(1, 1, "a b  d a"), (1, 2, "c"), (None, 1, "x y"), (3, 1, "")], key=str)
    assert "posexplode(split(sentence" not in plan(x)  # tokens are not sent one by one
