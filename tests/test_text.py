from urllib.parse import quote

from pyspark.sql import functions as F

from deckspark.functions import text as S
from deckspark.operators import joins as J


def col1(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_base_form_fixtures(spark):
    cases = {
        "die Sonne": "Sonne",
        "Haus (n)": "Haus",
        "gehen, ging": "gehen",
        "das": "das",
        "der grüne": "der grüne",
        "die alte Frau": "Frau",
        "Äpfel. pl": "Äpfel",
        "laufen": "laufen",
    }
    got = col1(spark, list(cases), S.base_form)
    assert got == list(cases.values())


def test_base_form_null(spark):
    df = spark.createDataFrame([(None,)], "x string")
    assert df.select(S.base_form("x")).first()[0] is None


def test_fix_sentence(spark):
    assert col1(spark, ['a/b "x"', "a/b", 'end"'], S.fix_sentence) == ['a.b "x".', "a.b", 'end".']


def test_clean_row(spark):
    assert col1(spark, ["| 12 | Wort |", "  |3 | a b | c|  "], S.clean_row) == ["12|Wort", "3|a b|c"]


def test_strip_is_python_strip(spark):
    vals = [" a ", "\tb\n", "c", "  ", "d e"]
    assert col1(spark, vals, S.strip) == [v.strip() for v in vals]


def test_pad_never_truncates(spark):
    df = spark.createDataFrame([(7,), (123456,)], "n long")
    assert [r[0] for r in df.select(S.pad("n", 5)).collect()] == [f"{7:05}", f"{123456:05}"]


def test_url_quote_matches_python(spark):
    vals = ["a b", "x/y?z=1&w", "ü~*'()!", "Grüße aus Köln"]
    assert col1(spark, vals, S.url_quote) == [quote(v) for v in vals]


def test_normalize_verb(spark):
    df = spark.createDataFrame([("verb", "go"), ("verb", "to go"), ("noun", "go"), ("verb", None)], "pos string, w string")
    got = [r[0] for r in df.select(J.normalize_verb(F.col("w"), F.col("pos"))).collect()]
    assert got == ["to go", "to go", "go", None]


def test_split_sentences(spark):
    df = spark.createDataFrame([("One. Two!  Three?\nFour",)], "t string")
    assert df.select(S.split_sentences("t")).first()[0] == ["One.", "Two!", "Three?", "Four"]


def test_token_count_counts_empty_tokens(spark):
    assert col1(spark, ["a  b", "a b"], S.token_count) == [3, 2]


def test_index_label(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(Decimal("5"),), (Decimal("5.001"),), (Decimal("12.0100"),)], "x decimal(18,6)")
    assert [r[0] for r in df.select(S.index_label("x")).collect()] == ["5", "5.001", "12.01"]


def test_split_article_and_last_word(spark):
    df = spark.createDataFrame([("die Sonne",), ("Haus",), ("fängt an",)], "x string")
    rows = df.select(S.split_article("x"), S.article_word("x"), S.last_word("x")).collect()
    assert [tuple(r) for r in rows] == [("die", "Sonne", "Sonne"), (None, "Haus", "Haus"), (None, "fängt an", "an")]
