from decimal import Decimal

from pyspark.sql import functions as F

from deckspark.operators import agg as G
from deckspark.operators import checks as C
from deckspark.operators import columns as P
from deckspark.operators import joins as J
from deckspark.operators import order as O
from deckspark.sources import readers as R
from deckspark.sources import sinks as K


def test_insert_promote_demote_trim(spark):
    df = spark.createDataFrame([(7, " a ", None)], "k long, w string, n int")
    assert P.insert_column(df, 1, "x", F.lit(1)).columns == ["k", "x", "w", "n"]
    up = P.promote_index(df, "k")
    assert up.columns == ["idx", "w", "n"] and up.first().idx == Decimal(7)
    assert tuple(P.demote_index(up, "k").first()) == (" a ", None, 7)
    assert P.trim_all(df).first().w == "a"  # a no-break space is white space


def test_group_order_and_line_range(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1), (4, None), (5, 9)], "i int, v int")
    got = [r.i for r in P.group_order(df, [F.col("v") > 4, F.col("v").isNotNull()], ["i"]).collect()]
    assert got == [2, 5, 3, 1, 4]
    assert [r.i for r in P.line_range(df, "i", 2, 3).orderBy("i").collect()] == [2, 3]
    assert P.line_range(df, "i", 4).count() == 2


def test_orders(spark):
    df = spark.createDataFrame([(Decimal(2), "10", None), (Decimal(1), "9", "x"), (Decimal(3), "100", "y")], "idx decimal(18,6), w string, c string")
    ids = lambda d: [int(r.idx) for r in d.collect()]
    assert ids(O.sort_index(df)) == [1, 2, 3] and ids(O.reverse_index(df)) == [3, 2, 1]
    assert ids(O.complete_first(df, "c")) == [1, 3, 2] and ids(O.order_numeric(df, "w")) == [1, 2, 3]
    assert ids(O.by_length(df, "w")) == [1, 2, 3] and ids(O.deck_order(df)) == [1, 2, 3]


def test_null_keys_in_duplicates_and_suppress(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    assert sorted(r.v for r in G.duplicates(df, "k").collect()) == [1, 2, 4, 5]
    got = {r.v: r.x for r in J.suppress(df.withColumn("x", F.col("v")), "k", ["b"], "x").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: None, 5: None}


def test_checks_see_missing_words_and_one_sided_blocks(spark):
    rows = [("1", "go"), ("1.001", None), ("1.002", "go"), ("2", None), ("2.001", "x"), ("3", "a"), ("3.001", "a"), ("4.001", "lone")]
    deck = spark.createDataFrame([(Decimal(i), w) for i, w in rows], "idx decimal(18,6), word string")
    bad = lambda d: sorted(float(r.idx) for r in d.collect())
    assert bad(C.check_same_word(deck)) == [1, 1.001, 2, 2.001]
    skip = spark.createDataFrame([(2,)], "b long")
    assert bad(C.check_same_word(deck, skip=skip, skip_col="b")) == [1, 1.001]
    assert bad(C.check_examples(deck.where("idx <> floor(idx)"), deck)) == [1.001, 2.001]
    verbs = spark.createDataFrame([(Decimal(i), t, "verb") for i, t in (("5", None), ("6", "to go"), ("7.5", "go"), ("8.25", "tomorrow"))], "idx decimal(18,6), t string, p string")
    assert bad(C.check_verbs(verbs, "idx", "t", "p")) == [5, 7.5, 8.25]
    assert bad(C.check_verbs(verbs, "idx", "t", "p", spark.createDataFrame([(7,)], "b long"), "b")) == [5, 8.25]
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert sorted(tuple(r) for r in C.check_block_lengths(a, b, "k").collect()) == [(2, 1, 0), (3, 0, 1)]


def test_pivot_and_titles(spark):
    df = spark.createDataFrame([(1, "de", "ja"), (1, "en", "yes"), (2, "de", "nein")], "k int, lang string, t string")
    assert [tuple(r) for r in J.pivot_pair(df, "k", "lang", "t", "de", "en").collect()] == [(1, "ja", "yes")]
    pairs = J.ordered_pairs(spark, ["en", "de", "de"])
    assert [tuple(r) for r in pairs.collect()] == [("de", "en")]
    labels = spark.createDataFrame([("de", "n", "1"), ("en", "n", "2"), ("de", "m", "3")], "lang string, label string, value string")
    assert [tuple(r) for r in J.deck_titles(pairs, labels, "lang", "label", "value").collect()] == [("de", "en", "n", "1 - 2")]


def test_note_file_keeps_data_lines_that_start_with_a_mark(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("#separator:comma\n#html:false\na<b,1\n#hash,2\n", encoding="utf8")
    path = f"file://{tmp_path}/notes.txt"
    got = sorted(tuple(r) for r in R.read_note_file(spark, path, ["w", "n"]).collect())
    assert got == [("#hash", "2"), ("a&lt;b", "1")]
    assert {(r.key, r.value) for r in R.read_directives(spark, path).collect()} == {("separator", "comma"), ("html", "false")}


def test_story_without_sentences_has_an_empty_body(spark):
    s = spark.createDataFrame([(1, 2, "x")], "k int, p int, t string")
    h = spark.createDataFrame([(1, "A"), (2, "B")], "k int, h string")
    got = {r.k: r.value for r in K.story_blocks(s, h, "k", "p", "t", "h").collect()}
    assert "<body>\nx\n</body>" in got[1] and "<header>B</header>\n<body>\n\n</body>" in got[2]
