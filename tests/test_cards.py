from pyspark.sql import functions as F

from deckspark.operators import cards as CD


def test_expand_cloze_three_cards(spark):
    df = spark.createDataFrame([("{{c1::2}} × {{c2::3}} = {{c3::6}}",)], "text string")
    out = CD.expand_cloze(df, "text").withColumn("answer", CD.cloze_answer("text", "cloze")).orderBy("cloze").collect()
    assert [r.front for r in out] == ["[...] × 3 = 6", "2 × [...] = 6", "2 × 3 = [...]"]
    assert {r.back for r in out} == {"2 × 3 = 6"}
    assert [r.answer for r in out] == ["2", "3", "6"]


def test_render_template_and_unresolved(spark):
    df = spark.createDataFrame([("Anna", "B2")], "name string, level string")
    r = CD.render_template(df, "{{name}} at {{level}} {{missing}}", ["name", "level"], "out")
    row = r.select("out", CD.unresolved("out").alias("left")).first()
    assert row.out == "Anna at B2 {{missing}}"
    assert row.left == ["{{missing}}"]


def test_render_cards_front_side_and_sections(spark):
    notes = spark.createDataFrame([("go", "gehen", ""), ("eat", "essen", "verb")], "en string, de string, hint string")
    tpl = [("t", "{{en}}{{#hint}} ({{hint}}){{/hint}}", "{{FrontSide}}|{{de}} {{tts de_DE:de}}")]
    out = {r.en: (r.front, r.back) for r in CD.render_cards(notes, tpl, ["en", "de", "hint"]).collect()}
    assert out["go"] == ("go", "go|gehen {{tts de_DE:de}}")
    assert out["eat"] == ("eat (verb)", "eat (verb)|essen {{tts de_DE:de}}")


def test_cloze_numbers_of_any_length(spark):
    df = spark.createDataFrame([("{{c99999999999::a}} {{c2::b}}",), ("none",), (None,)], "text string")
    out = sorted((tuple(r) for r in CD.expand_cloze(df, "text").select("cloze", "front", "back").collect()), key=str)
    assert out == [(2, "a [...]", "a b"), (None, "[...] b", "a b")]
