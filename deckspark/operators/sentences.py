"""STR-19: sentences, with abbreviations learnt from the texts themselves.

A full stop ends a sentence unless its word is an abbreviation.  Which words
are is learnt without supervision, from counts over the whole table (Kiss and
Strunk, 2006): the log-likelihood ratio of "the word nearly always has a full
stop" against "it has one as often as any word", times factors for short
words, for full stops inside the word, and against words that also occur
without one.  After an abbreviation a sentence ends only if the next word is
one that is written small elsewhere and never starts with a capital inside a
sentence.

Counting and deciding are one aggregation of word types and one join of the
few words that end in a full stop; texts are cut where they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

THRESHOLD = 0.3
SURE = 0.99  # share of an abbreviation's occurrences that have a full stop

# expressions that Java and RE2 read alike
OPENING = r"^[^\p{L}\p{N}]+"
CLOSING = r"[^\p{L}\p{N}.!?]+\z"  # quotes and brackets behind a word
NUMBER = r"\d+([.,]\d+)*"


def text_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """(tid, line, words) of the different texts, written: their lines with
    words in them.  Learning and splitting may share it."""
    each = texts.select(F.unhex(F.md5(text)).alias("tid"), F.col(text).alias("__text")).where("__text is not null").dropDuplicates(["tid"])
    lines = each.select("tid", F.posexplode(F.split("__text", "\n")).alias("line", "__line"))
    return cut_lineage(lines.select("tid", "line", F.col("__line").alias("words")).where(F.col("words").rlike(r"[^ \t\r]")), "text-lines")


def _toks() -> Column:
    """The words of a line, which is passed on as it is: an array is larger."""
    return F.filter(F.split("words", r"[ \t\r]+"), lambda x: x != "")


def _bare(word: Column) -> Column:
    """A word without opening and closing punctuation; full stops and other
    marks at its end stay."""
    return F.regexp_replace(F.regexp_replace(word, OPENING, ""), CLOSING, "")


def _kind(bare: Column) -> Column:
    """The type of a word: small letters, any number as 0, without its final
    full stop."""
    return F.regexp_replace(F.lower(F.regexp_replace(bare, r"\.\z", "")), NUMBER, "0")


def _stopped(bare: Column) -> Column:
    return bare.endswith(".") & ~bare.endswith("..")


def _words(lines: DataFrame) -> DataFrame:
    """Every word with its type, whether a full stop follows, and how it is
    written where no sentence can start before it."""
    each = lines.select("toks", F.posexplode("toks").alias("i", "word"))
    bare, before = _bare(F.col("word")), F.get("toks", F.col("i") - 1)
    inside = (F.col("i") > 0) & ~_bare(before).rlike(r"[.!?]\z")
    x = each.select(bare.alias("bare"), inside.alias("inside")).where(F.col("bare").rlike(r"[\p{L}\p{N}]"))
    return x.select(
        _kind(F.regexp_replace("bare", r"[!?]+\z", "")).alias("kind"),
        _stopped(F.col("bare")).alias("stop"),
        F.col("bare").rlike(r"^\p{Ll}").alias("small"),
        (F.col("inside") & F.col("bare").rlike(r"^\p{Lu}")).alias("capital"),
    )


def learn_sentence_ends(texts: DataFrame, text: str = "text", lines: DataFrame | None = None) -> DataFrame:
    """(kind, abbreviation, starter): word types that are abbreviations, and
    those whose capital tells that a sentence starts.  Texts that occur
    several times teach once."""
    lines = text_lines(texts, text) if lines is None else lines
    kinds = _words(lines.select(_toks().alias("toks"))).groupBy("kind").agg(
        F.count_if("stop").alias("n_stop"), F.count_if(~F.col("stop")).alias("n_plain"), F.count_if("small").alias("n_small"), F.count_if("capital").alias("n_capital")
    )
    kinds = cut_lineage(kinds, "word-kinds")
    stops, all_ = kinds.agg(F.sum("n_stop"), F.sum(F.col("n_stop") + F.col("n_plain"))).first()
    p = min(max((stops or 0) / (all_ or 1), 1e-9), 1 - 1e-9)
    a, b = F.col("n_stop"), F.col("n_plain")
    ratio = 2 * (a * math.log(SURE / p) + b * math.log((1 - SURE) / (1 - p)))
    dots = F.length("kind") - F.length(F.replace("kind", F.lit("."), F.lit("")))
    letters = F.length("kind") - dots
    score = ratio * F.exp(-letters) * (dots + 1) * F.pow(letters, -b)
    marked = kinds.select(
        "kind", ((a > 0) & (score >= THRESHOLD)).alias("abbreviation"), ((F.col("n_small") > 0) & (F.col("n_capital") == 0)).alias("starter")
    )
    return marked.where("abbreviation or starter")


def sentence_ends(lines: DataFrame, model: DataFrame) -> DataFrame:
    """(tid, line, i): the words that end a sentence before the line does."""
    each = lines.select("tid", "line", "toks", F.posexplode("toks").alias("i", "word"))
    bare, after = _bare(F.col("word")), F.get("toks", F.col("i") + 1)
    x = each.select("tid", "line", "i", bare.alias("bare"), _bare(after).alias("next")).where(F.col("bare").rlike(r"[.!?]\z") & F.col("next").isNotNull())
    short = model.where("abbreviation").select(F.col("kind").alias("__kind"), F.lit(True).alias("short"))
    start = model.where("starter").select(F.col("kind").alias("__next"), F.lit(True).alias("starts"))
    x = x.withColumns({"kind": _kind(F.col("bare")), "next_kind": _kind(F.regexp_replace("next", r"[!?]+\z", ""))})
    dotted = F.when(F.col("bare").endswith("."), F.col("kind"))
    j = x.withColumn("dotted", dotted).join(short, F.col("dotted") == F.col("__kind"), "left")
    j = j.join(start, F.col("next_kind") == F.col("__next"), "left")
    # several full stops trail off; they end a sentence as abbreviations do
    unsure = F.col("bare").endswith(".") & (F.col("short").isNotNull() | F.col("bare").endswith(".."))
    begins = F.col("next").rlike(r"^\p{Lu}") & F.col("starts").isNotNull()
    return j.where(~unsure | begins).select("tid", "line", "i")


def split_sentences(texts: DataFrame, model: DataFrame, text: str = "text", lines: DataFrame | None = None) -> DataFrame:
    """``texts`` with ``i`` (from 1) and ``sentence``, one row per sentence; a
    text without words has none.  A line ends a sentence, too; white space
    inside a sentence becomes one space; null texts and texts of white space
    give no row."""
    lines = text_lines(texts, text) if lines is None else lines
    ends = sentence_ends(lines.select("tid", "line", _toks().alias("toks")), model).groupBy("tid", "line").agg(F.collect_list(F.col("i") + 1).alias("ends"))
    stops = F.concat(F.array(F.lit(0)), F.coalesce("ends", F.array().cast("array<int>")), F.array(F.size("toks")))
    cut = lines.join(ends, ["tid", "line"], "left").withColumn("toks", _toks()).withColumn("stops", F.array_sort(stops))
    each = F.transform(F.slice("stops", 1, F.size("stops") - 1), lambda s, k: F.array_join(F.slice("toks", s + 1, F.get("stops", k + 1) - s), " "))
    whole = cut.select("tid", F.struct("line", each.alias("s")).alias("l")).groupBy(F.col("tid").alias("__id")).agg(F.array_sort(F.collect_list("l")).alias("__lines"))
    j = texts.drop("i", "sentence").withColumn("__id", F.unhex(F.md5(text))).join(whole, "__id")
    sentences = F.flatten(F.col("__lines.s"))
    out = j.select(*[c for c in texts.columns if c not in ("i", "sentence")], F.posexplode(sentences).alias("i", "sentence"))
    return out.withColumn("i", (F.col("i") + 1).cast("bigint"))
