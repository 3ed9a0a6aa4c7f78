import os
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckspark.session import scratch_path
from deckspark.sources import readers as R
from deckspark.sources import sinks as K


def write_text(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-00000.txt"), "w", encoding="utf8") as f:
        f.write(text)


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_read_deck_pads_short_rows(spark):
    p = local(scratch_path(spark, "t-deck"))
    write_text(p, "idx|word|sentence\n1|Haus\n2.001|gehen|Ich gehe.\n")
    rows = R.read_deck(spark, p, ["word", "sentence"]).orderBy("idx").collect()
    assert [tuple(r) for r in rows] == [(Decimal("1"), "Haus", None), (Decimal("2.001"), "gehen", "Ich gehe.")]


def test_ragged_lines(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, "b", "c", None)], "i int, a string, b string, c string")
    assert [r[0] for r in K.ragged_lines(df, ["i", "a", "b", "c"]).collect()] == ["1|a", "2|b|c"]


def test_story_round_trip(spark):
    p = scratch_path(spark, "t-stories")
    sentences = spark.createDataFrame([(1, 1, "Eins."), (1, 2, "Zwei & drei."), (2, 1, "Solo.")], "t int, p int, s string")
    headers = spark.createDataFrame([(1, "First\nstory"), (2, "Second")], "t int, h string")
    K.write_stories(sentences, headers, "t", "p", "s", "h", p)
    got = {r.n: (r.header, r.body) for r in R.read_stories(spark, p).collect()}
    assert got == {1: ("First story", ["Eins.", "Zwei & drei."]), 2: ("Second", ["Solo."])}


def test_read_blocks_last_entry_wins(spark):
    p = local(scratch_path(spark, "t-blocks"))
    write_text(
        p,
        "<block>\n<index>0001</index>\n<body>\nold\n</body>\n</block>\n"
        "<block>\n<index>0002</index>\n<body>\nb1\nb2\n</body>\n</block>\n"
        "<block>\n<index>0001</index>\n<body>\nnew\n</body>\n</block>\n",
    )
    got = {r.block_index: r.lines for r in R.read_blocks(spark, p).collect()}
    assert got == {1: ["new"], 2: ["b1", "b2"]}


def test_read_or_empty(spark):
    schema = T.StructType([T.StructField("a", T.StringType())])
    df = R.read_or_empty(spark, scratch_path(spark, "t-none"), schema)
    assert df.count() == 0 and df.columns == ["a"]


def test_read_lines_numbers_across_part_files(spark):
    p = scratch_path(spark, "t-lines")
    df = spark.range(0, 3000).repartition(5).withColumn("line", F.format_string("line %05d", "id"))
    K.write_lines(df, "line", ["id"], p)
    got = R.read_lines(spark, p).orderBy("line_no").collect()
    assert [r.line for r in got] == [f"line {i:05d}" for i in range(3000)]
    assert [r.line_no for r in got] == list(range(1, 3001))


def test_read_responses_slots(spark):
    p = local(scratch_path(spark, "t-resp"))
    write_text(p, '[{"model":"m"},{"choices":[]}]\n[{"model":"m"},["err a","err b"]]\n[{"model":"m"},{"x":1},{"row":5}]\n')
    rows = R.read_responses(spark, p).collect()
    assert [r.failed for r in rows] == [False, True, False]
    assert rows[2].metadata == '{"row":5}'


def test_write_parts(spark):
    p = scratch_path(spark, "t-parts")
    df = spark.createDataFrame([(i, r) for i, r in enumerate([1, 1700, 1701, 3400, 3401, None])], "i int, rank int")
    K.write_parts(df, "rank", [1700, 3400], p)
    back = spark.read.csv(p, sep="|", header=True)
    got = sorted((int(r.i), int(r.part)) for r in back.collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]


def test_long_stories_line_by_line(spark):
    """One story of 20,000 lines over several files, one without lines, line
    ends in a header and a sentence, lines that look like marks elsewhere."""
    p = scratch_path(spark, "t-stories")
    long_ = spark.range(20_000).selectExpr("cast(2 as int) t", "cast(id + 1 as int) p", "concat('line ', id, repeat('x', 200)) s").repartition(6)
    few = spark.createDataFrame([(1, 1, "Eins.\nZwei"), (1, 2, "a < b <n>7</n>"), (4, 1, "Ende"), (9, 1, "no header"), (4, 2, None)], "t int, p int, s string")
    headers = spark.createDataFrame([(1, "First\nstory"), (2, "Long"), (3, "Empty"), (4, None)], "t int, h string")
    sizes = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_stories(long_.unionByName(few), headers, "t", "p", "s", "h", p, whole=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", sizes)
    assert len([f for f in os.listdir(local(p)) if f.startswith("part")]) > 1
    got = {}
    for r in R.read_story_lines(spark, p).orderBy("story", "pos").collect():
        got.setdefault((r.story, r.n, r.header), []).append((r.pos, r.sentence))
    want_long = [(i + 1, f"line {i}" + "x" * 200) for i in range(20_000)]
    assert got == {(1, 1, "First story"): [(1, "Eins. Zwei"), (2, "a < b <n>7</n>")], (2, 2, "Long"): want_long, (4, 4, ""): [(1, "Ende")]}
    q = scratch_path(spark, "t-stories")
    K.write_stories(long_.unionByName(few), headers, "t", "p", "s", "h", q)
    blocks = {r.n: len(r.body) for r in R.read_stories(spark, q).collect()}
    assert blocks == {1: 2, 2: 20_000, 3: 1, 4: 1}


def test_note_files_with_their_own_directives(spark):
    p = local(scratch_path(spark, "t-notes"))
    os.makedirs(p)
    texts = {
        "a.txt": "#separator:semicolon\n#html:false\na<b;x & y\n#not;a directive\n",
        "b.txt": "#html:true\n#separator:Pipe\n<b>1</b>|two\n",
        "c.txt": "tab\there\n#separator:comma\tlate\n",
        "d.txt": "#separator:comma\n#separator:$\n1$\"q$r\"\n",
        "e.txt": "#separator:comma\n",
    }
    for name, text in texts.items():
        with open(os.path.join(p, name), "w", encoding="utf8") as f:
            f.write(text)
    got = sorted(tuple(r) for r in R.read_note_file(spark, p, ["front", "back"]).collect())
    assert got == sorted([("a&lt;b", "x &amp; y"), ("#not", "a directive"), ("<b>1</b>", "two"), ("tab", "here"), ("#separator:comma", "late"), ("1", "q$r")])
    plan = R.read_note_file(spark, p, ["front", "back"])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan  # the files themselves were read once, before


def test_no_directives_use_tabs(spark):
    p = local(scratch_path(spark, "t-notes"))
    write_text(p, "a\tb\nc\n")
    assert sorted(tuple(r) for r in R.read_note_file(spark, p, ["x", "y"]).collect()) == [("a", "b"), ("c", None)]
    assert [tuple(r) for r in R.read_note_file(spark, p, ["x", "y"], sep="b").where("x like 'a%'").collect()] == [("a\t", None)]


def test_sentence_deck_with_codec(spark, tmp_path):
    rows = [(i, 7, f'a "{i}"', "b|c", "", "x", "y", "", "T", None) for i in range(1, 301)]
    names = "sentence_id long, text_id long, `from` string, `to` string, from_prev string, to_prev string, from_next string, to_next string, from_title string, to_title string"
    cards = spark.createDataFrame(rows, names).repartition(5)
    lines = []
    for codec in (None, "gzip"):
        K.write_sentence_deck(cards, f"{tmp_path}/{codec}", codec)
        lines.append(sorted(tuple(r) for r in R.read_lines(spark, f"{tmp_path}/{codec}", line_col="value").collect()))
    assert lines[0] == lines[1] and len(lines[0]) == 300
    assert lines[0][0] == (1, '00001|0007|a ""1""|b|c||x|y||T|02|01')
