"""Scans (SRC-*): deck files, delimited lists, line files, tagged text blocks,
JSONL response logs, record documents, note files, crawled pages.

Every reader takes an explicit schema (no inference pass over the data) and
returns a DataFrame whose work is split by Spark over file splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.text import strip
from ..schema import IDX, RECORD_SCHEMA
from ..session import cut_lineage


def _schema(names: list[str], types: dict | None = None) -> T.StructType:
    types = types or {}
    return T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])


# SRC-01 -- pipe CSV, first (unnamed) column = index, header gives the rest;
# short rows are null-padded (PERMISSIVE)
def read_deck(spark: SparkSession, path: str, columns: list[str], types: dict | None = None) -> DataFrame:
    sch = T.StructType([T.StructField("idx", IDX, True)] + list(_schema(columns, types).fields))
    return spark.read.csv(path, sep="|", header=True, schema=sch, quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True)


# SRC-02 / SRC-06 -- headerless delimited file, names by position
def read_delimited(spark: SparkSession, path: str, names: list[str], sep: str = "|", types: dict | None = None, header: bool = False) -> DataFrame:
    return spark.read.csv(path, sep=sep, header=header, schema=_schema(names, types), quote='"', escape='"', mode="PERMISSIVE")


# SRC-03 -- headerless id|value list
def read_id_value(spark: SparkSession, path: str, value_col: str = "value") -> DataFrame:
    return read_delimited(spark, path, ["id", value_col], "|", {"id": T.IntegerType()})


# SRC-04 -- comma CSV dictionary with a header; only the needed columns are
# parsed (the CSV reader prunes the rest)
def read_dictionary(spark: SparkSession, path: str, all_columns: list[str], columns: list[str]) -> DataFrame:
    df = spark.read.csv(path, sep=",", header=True, schema=_schema(all_columns), quote='"', escape='"')
    return df.select(*columns)


# SRC-05 -- semicolon label matrix
def read_matrix(spark: SparkSession, path: str, columns: list[str], sep: str = ";") -> DataFrame:
    return spark.read.csv(path, sep=sep, header=True, schema=_schema(columns))


# SRC-07 / SRC-12 -- one record per line with its 1-based line number.
# A split's lines are read by one task in their order, so
# monotonically_increasing_id less the split's least value is a line's place in
# it; one row per split says how many lines come before.  Lines stay where
# they are read, and no task holds a whole file.
def read_lines(spark: SparkSession, path: str, skip_header: bool = False, line_col: str = "line", across_files: bool = True) -> DataFrame:
    """``line_no`` counts within each file; with ``across_files`` the files
    (part files of one ordered write) are chained in name order."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__mid"), F.col("value").alias(line_col)
    )
    splits = raw.groupBy(F.col("__file").alias("__f"), F.col("__start").alias("__s")).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    header = F.when(F.row_number().over(Window.partitionBy("__f").orderBy("__s")) == 1, 1).otherwise(0) if skip_header else F.lit(0)
    splits = splits.withColumn("__header", header).withColumn("__n", F.col("__n") - F.col("__header"))
    order = Window.orderBy("__f", "__s") if across_files else Window.partitionBy("__f").orderBy("__s")  # one row per split
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("__before", before)
    j = raw.join(F.broadcast(splits), (F.col("__file") == F.col("__f")) & (F.col("__start") == F.col("__s")))
    place = F.col("__mid") - F.col("__first") + 1 - F.col("__header")
    return j.where(place > 0).select((F.col("__before") + place).cast("bigint").alias("line_no"), line_col)


# SRC-08 -- <txt><n/><header/><body>one sentence per line</body></txt> blocks
# (not XML: no root, unescaped text).  Records are cut at "</txt>".
def read_stories(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, lineSep="</txt>")
    n = F.regexp_extract("value", r"<n>\s*(\d+)\s*</n>", 1)
    header = F.regexp_extract("value", r"(?s)<header>(.*?)</header>", 1)
    body = strip(F.regexp_extract("value", r"(?s)<body>(.*?)</body>", 1))
    return raw.where(F.col("value").contains("<txt>")).select(
        n.cast("int").alias("n"), strip(header).alias("header"), F.split(body, "\n").alias("body")
    )


def read_story_lines(spark: SparkSession, path: str) -> DataFrame:
    """(story, n, header, pos, sentence): one row per body line, ``pos`` from
    1; ``story`` counts the blocks in order.  Stories of any length, also
    across part files: each line learns its block from the lines before it by
    prefix scans, so no story is one row.  A story without body lines, and
    what is outside of bodies, gives no row; lines are taken as written, but
    for white space at their ends; blank ones count but give no row."""
    from ..operators.scan import LAST, SUM, prefix_scan

    lines = read_lines(spark, path, line_col="value").withColumn("value", strip("value"))
    v = F.col("value")
    number, title = F.regexp_extract(v, r"^<n>\s*(\d+)\s*</n>$", 1), F.regexp_extract(v, r"^<header>(.*)</header>$", 1)
    place = F.when(v.isin("<txt>", "</body>", "</txt>"), F.struct(F.lit(False).alias("inside"), F.col("line_no").alias("at")))
    place = place.when(v == "<body>", F.struct(F.lit(True).alias("inside"), F.col("line_no").alias("at")))
    x = prefix_scan(
        lines,
        [],
        ["line_no"],
        {
            "story": ((v == "<txt>").cast("long"), SUM),
            "n": (F.when(v == "<txt>", -1).when(number != "", number.try_cast("int")), LAST),
            "header": (F.when(v == "<txt>", "").when(v.rlike("^<header>.*</header>$"), strip(title)), LAST),
            "place": (place, LAST),
        },
    )
    inside = F.coalesce("place.inside", F.lit(False)) & (v != "<body>") & (v != "")
    n = F.when(F.col("n") >= 0, F.col("n"))
    return x.where(inside).select("story", n.alias("n"), "header", (F.col("line_no") - F.col("place.at")).alias("pos"), F.col("value").alias("sentence"))


# SRC-09 -- appended progress log of <block><index/><body/></block>; an index
# may repeat and the last entry wins.
def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.agg import last_per_key

    raw = spark.read.text(path, lineSep="</block>").select(
        F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__mid"), "value"
    )
    raw = raw.where(F.col("value").contains("<block>"))
    idx = F.regexp_extract("value", r"<index>\s*(\d+)\s*</index>", 1).cast("int")
    body = strip(F.regexp_extract("value", r"(?s)<body>(.*?)</body>", 1))
    blocks = raw.select(idx.alias("block_index"), body.alias("body"), "__file", "__mid")
    return last_per_key(blocks, "block_index", ["__file", "__mid"]).select("block_index", F.split("body", "\n").alias("lines"))


# SRC-10 -- JSONL of [request, response] / [request, response, metadata];
# failures carry a list of error strings in slot 2.
def read_responses(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path)
    arr = F.from_json("value", "array<string>")
    return raw.select(arr.alias("__a")).select(
        F.col("__a")[0].alias("request"),
        F.col("__a")[1].alias("response"),
        F.try_element_at("__a", F.lit(3)).alias("metadata"),
        F.col("__a")[1].startswith("[").alias("failed"),
    )


# SRC-11 -- list of records (title, author, multi-line text) as a table
def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA, multi_line: bool = False) -> DataFrame:
    """JSON Lines by default (splittable); ``multi_line`` for one JSON array
    document per file."""
    return spark.read.json(path, schema=schema, multiLine=multi_line)


# SRC-13 -- an absent table reads as empty with the declared columns
def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", **opts) -> DataFrame:
    try:
        return spark.read.schema(schema).format(fmt).options(**opts).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


# SRC-14 -- note file with leading "#key:value" directive lines.  Only the
# lines before a file's first other line are directives; later lines may
# start with "#" as any data.
SEPARATORS = {"tab": "\t", "comma": ",", "semicolon": ";", "pipe": "|", "space": " ", "colon": ":"}


def _note_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(directive lines, data lines) with their ``__file``: those before and
    from each file's first data line, whose place is one row per file.  The
    files are read once, and their lines written as they are read."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__place"), "value")
    raw = cut_lineage(raw, "note-lines")
    first = raw.where(~F.col("value").startswith("#")).groupBy(F.col("__file").alias("__f")).agg(F.min("__place").alias("__first"))
    x = raw.join(F.broadcast(first), F.col("__file") == F.col("__f"), "left").drop("__f")
    data = F.coalesce(F.col("__place") >= F.col("__first"), F.lit(False))
    return x.where(~data).drop("__first"), x.where(data).drop("__first")


def _directives(lines: DataFrame) -> DataFrame:
    kv = F.split(F.expr("substring(value, 2)"), ":", 2)
    return lines.select("__file", "__place", F.trim(kv[0]).alias("key"), F.trim(F.get(kv, 1)).alias("value"))


def read_directives(spark: SparkSession, path: str) -> DataFrame:
    return _directives(_note_lines(spark, path)[0]).select("key", "value").distinct()


def read_note_file(spark: SparkSession, path: str, names: list[str], sep: str | None = None) -> DataFrame:
    """``sep`` defaults to the file's own ``#separator``, else a tab; of a
    directive that a file repeats the last counts.  Under ``#html:false`` the
    fields of a file are plain text and their markup characters are escaped,
    so that they show as written on a card."""
    head, data = _note_lines(spark, path)
    last = lambda k: F.max_by("value", F.when(F.col("key") == k, F.col("__place")))
    per_file = _directives(head).groupBy("__file").agg(last("separator").alias("__sep"), last("html").alias("__html"))
    # one row per file
    rows = data.join(F.broadcast(per_file.select(F.col("__file").alias("__f"), "__sep", "__html")), F.col("__file") == F.col("__f"), "left")
    schema = ", ".join(f"`{n}` string" for n in names)
    parse = lambda by: F.from_csv("value", schema, {"sep": by, "quote": '"', "escape": '"'})
    if sep is not None:
        fields = parse(sep)
    else:
        # one way to parse per separator that a file names: as many as there
        # are different ones, not files
        used = [r[0] for r in per_file.where("__sep is not null").select("__sep").distinct().collect()]
        fields = F.lit(None)
        for u in used:
            fields = F.when(F.col("__sep") == u, parse(SEPARATORS.get(u.lower(), u))).otherwise(fields)
        fields = F.when(F.col("__sep").isNull(), parse("\t")).otherwise(fields) if used else parse("\t")
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    plain = F.coalesce(F.col("__html") == "false", F.lit(False))
    rows = rows.select(fields.alias("__fields"), plain.alias("__plain"))
    return rows.select(*[F.when(F.col("__plain"), escaped(F.col(f"__fields.`{n}`"))).otherwise(F.col(f"__fields.`{n}`")).alias(n) for n in names])


# SRC-15 -- crawled pages
def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")
