"""Sinks (SNK-*): decks, ragged lines, lists, parts, request batches,
result logs, story blocks, sentence decks, records, rendered descriptions.

Ordered outputs use ``orderBy`` before the write: Spark range-partitions the
rows, so the part files are in order and no single task sorts everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_quotes, pad, token_count
from ..operators.window import number_rows


def _strs(df: DataFrame, cols: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]


# SNK-01 -- deck as pipe CSV, index first, header (index column unnamed)
def write_deck(df: DataFrame, path: str, idx: str = "idx", mode: str = "overwrite") -> None:
    cols = [idx] + [c for c in df.columns if c != idx]
    df.select(*cols).orderBy(idx).write.mode(mode).csv(path, sep="|", header=True, quote='"', escape='"')


# SNK-02 -- ragged lines: trailing separators cut from every line
def ragged_lines(df: DataFrame, cols: list[str], sep: str = "|", keep: list[str] | None = None) -> DataFrame:
    import re

    line = F.concat_ws(sep, *_strs(df, cols))
    return df.select(*(keep or []), F.regexp_replace(line, re.escape(sep) + "+$", "").alias("value"))


def write_ragged(df: DataFrame, cols: list[str], path: str, order: list | None = None) -> None:
    out = df.orderBy(*order) if order else df
    ragged_lines(out, cols).write.mode("overwrite").text(path)


# SNK-03 -- headerless id|value list, id = position from 0 in `order`
def id_value(df: DataFrame, col: str, order: list, **kw) -> DataFrame:
    n = number_rows(df, [], order, "__rn", **kw)
    return n.select((F.col("__rn") - 1).alias("id"), F.col(col).alias("value"))


def write_id_value(df: DataFrame, col: str, order: list, path: str, **kw) -> None:
    id_value(df, col, order, **kw).orderBy("id").write.mode("overwrite").csv(path, sep="|", header=False)


# SNK-04 -- chosen columns, no index
def write_columns(df: DataFrame, cols: list[str], path: str, sep: str = "|", header: bool = True) -> None:
    df.select(*cols).write.mode("overwrite").csv(path, sep=sep, header=header, quote='"', escape='"')


# SNK-05 -- unquoted export: fields written verbatim
def write_unquoted(df: DataFrame, cols: list[str], path: str, sep: str = "|") -> None:
    df.select(F.concat_ws(sep, *_strs(df, cols)).alias("value")).write.mode("overwrite").text(path)


# SNK-06 -- one output per rank band
def with_part(df: DataFrame, rank_col: str, cutoffs: list[int], out: str = "part") -> DataFrame:
    r = F.col(rank_col)
    expr = None
    lo = None
    for i, hi in enumerate(cutoffs, start=1):
        cond = (r <= hi) if lo is None else ((r > lo) & (r <= hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
        lo = hi
    expr = expr.when(r > lo, F.lit(len(cutoffs) + 1))
    return df.withColumn(out, expr).where(F.col(out).isNotNull())


def write_parts(df: DataFrame, rank_col: str, cutoffs: list[int], path: str, fmt: str = "csv") -> None:
    with_part(df, rank_col, cutoffs).write.mode("overwrite").partitionBy("part").format(fmt).option("sep", "|").option(
        "header", True
    ).save(path)


# SNK-07 -- request batches as JSONL, replacing the previous file
def write_requests(requests: DataFrame, col: str, path: str) -> None:
    requests.select(F.col(col).alias("value")).write.mode("overwrite").text(path)


# SNK-08 -- append one JSON result per finished request
def append_results(results: DataFrame, col: str, path: str) -> None:
    results.select(F.col(col).alias("value")).write.mode("append").text(path)


# SNK-09 -- one value per line, in order
def write_lines(df: DataFrame, col: str, order: list, path: str) -> None:
    df.orderBy(*order).select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


# SNK-10 -- story blocks from sentence rows (a story is one bounded group); a
# story without sentences has an empty body
def story_blocks(sentences: DataFrame, headers: DataFrame, key: str, pos: str, line: str, header: str) -> DataFrame:
    g = sentences.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(pos, line))).alias("__s"))
    body = F.coalesce(F.array_join(F.transform("__s", lambda s: s[line]), "\n"), F.lit(""))
    j = headers.select(key, header).join(g, key, "left")
    h = F.replace(F.trim(F.col(header)), F.lit("\n"), F.lit(" "))
    text = F.format_string("<txt>\n<n>%s</n>\n<header>%s</header>\n<body>\n%s\n</body>\n</txt>", F.col(key).cast("string"), h, body)
    return j.select(key, text.alias("value"))


def story_lines(sentences: DataFrame, headers: DataFrame, key: str, pos: str, line: str, header: str) -> DataFrame:
    """(key, part, pos, value): the lines of the story blocks, one row each;
    in order of these columns they are the text of the file.  Line ends
    inside a sentence or header become spaces, so that a line is a line."""
    one_line = lambda c: F.regexp_replace(c, "[\r\n]+", " ")
    title = F.concat(F.lit("<header>"), one_line(F.coalesce(F.trim(F.col(header)), F.lit(""))), F.lit("</header>"))
    opening = F.array(F.lit("<txt>"), F.concat(F.lit("<n>"), F.col(key).cast("string"), F.lit("</n>")), title, F.lit("<body>"))
    around = F.concat(F.transform(opening, lambda v, i: F.struct(F.lit(0).alias("part"), i.cast("long").alias("pos"), v.alias("value"))),
                      F.transform(F.array(F.lit("</body>"), F.lit("</txt>")), lambda v, i: F.struct(F.lit(2).alias("part"), i.cast("long").alias("pos"), v.alias("value"))))
    frame = headers.where(F.col(key).isNotNull()).select(key, F.explode(around).alias("x")).select(key, "x.*")
    body = sentences.where(F.col(line).isNotNull()).select(key, F.lit(1).alias("part"), F.col(pos).cast("long").alias("pos"), one_line(F.col(line)).alias("value"))
    told = headers.select(key).distinct()
    return frame.unionByName(body.join(told, key, "left_semi"))


def write_stories(sentences: DataFrame, headers: DataFrame, key: str, pos: str, line: str, header: str, path: str, whole: bool = True) -> None:
    """Story blocks in order of ``key``, which names each story once.  Lines
    are written row by row: a story of any length fits.  ``whole`` keeps each
    story in one file, for readers of blocks; otherwise long stories are
    spread over files, in order (see ``readers.read_story_lines``)."""
    lines = story_lines(sentences, headers, key, pos, line, header)
    by = [key, "part", "pos"]
    dealt = lines.repartitionByRange(key).sortWithinPartitions(*by) if whole else lines.orderBy(*by)
    dealt.select("value").write.mode("overwrite").text(path)


# SNK-11 -- 12-field sentence cards, zero-padded ids, quotes doubled
SENTENCE_DECK_FIELDS = [
    "sentence_id", "text_id", "from", "to", "from_prev", "to_prev",
    "from_next", "to_next", "from_title", "to_title", "from_tokens_number", "to_tokens_number",
]


def sentence_deck_lines(cards: DataFrame) -> DataFrame:
    fields = [
        pad("sentence_id", 5), pad("text_id", 4), F.col("from"), F.col("to"), F.col("from_prev"), F.col("to_prev"),
        F.col("from_next"), F.col("to_next"), F.col("from_title"), F.col("to_title"),
        pad(token_count("from"), 2), pad(token_count("to"), 2),
    ]
    return cards.select("sentence_id", escape_quotes(F.concat_ws("|", *fields)).alias("value"))


def write_sentence_deck(cards: DataFrame, path: str, codec: str | None = None) -> None:
    """``codec`` compresses the files: a line repeats those beside it."""
    sentence_deck_lines(cards).orderBy("sentence_id").select("value").write.mode("overwrite").text(path, compression=codec)


# SNK-12 -- every block of rows as one payload "idx|word\n..."
def block_payload(df: DataFrame, block: str, order: str, cols: list[str], sep: str = "|") -> DataFrame:
    row = F.concat_ws(sep, *_strs(df, cols))
    g = df.groupBy(block).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), row.alias("r")))).alias("__p"))
    return g.select(block, F.array_join(F.transform("__p", lambda s: s["r"]), "\n").alias("payload"))


# read back by SRC-14 -- lines under the directives of their file: each file
# begins with them, so that rows need no order and no file all of them
def write_note_file(df: DataFrame, col: str, directives: list[str], path: str) -> None:
    x = df.select(F.col(col).alias("__line"), F.monotonically_increasing_id().alias("__at"))
    begins = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) == 0  # a task's first row
    lines = F.when(begins, F.array(*[F.lit(d) for d in directives], F.col("__line"))).otherwise(F.array("__line"))
    x.select(F.explode(lines).alias("value")).write.mode("overwrite").text(path)


# SNK-13 -- nested title/author/text records
def write_records(df: DataFrame, path: str) -> None:
    df.select("title", "author", "text").write.mode("overwrite").json(path)


# SNK-14 -- one rendered description per deck part
def write_rendered(df: DataFrame, part: str, col: str, path: str) -> None:
    df.select(part, F.col(col).alias("value")).write.mode("overwrite").partitionBy(part).text(path)


# SNK-15 -- reset an output to empty before a run
def truncate_table(spark, path: str, schema, fmt: str = "parquet") -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").format(fmt).save(path)
