"""Data-quality checks (DQ-*): each returns the offending rows as a
DataFrame instead of raising, so a job decides what to do with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import index as ix


# FL-14 -- drop whole index blocks listed in `blocks[col]` (anti-join, so the
# list may be as large as the data)
def exclude_blocks(df: DataFrame, blocks: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    b = blocks.select(F.col(col).cast("bigint").alias("__blk"))
    return df.join(b, ix.root(df[idx]) == b["__blk"], "left_anti")


# DQ-01 -- duplicate indices with their multiplicity
def check_unique(df: DataFrame, idx: str = "idx") -> DataFrame:
    return df.groupBy(idx).agg(F.count(F.lit(1)).cast("bigint").alias("n")).where("n > 1")


# DQ-02 -- fractions at or above the reserved bound
def check_fraction(df: DataFrame, idx: str = "idx", bound: str = "0.01") -> DataFrame:
    return df.where(ix.fraction_at_least(idx, bound))


def _differs(a: str, b: str) -> Column:
    """A missing value on either side is a mismatch, both missing too."""
    return F.col(a).isNull() | F.col(b).isNull() | (F.col(a) != F.col(b))


def _skip_blocks(df: DataFrame, idx: str, skip: DataFrame | None, skip_col: str | None) -> DataFrame:
    return df if skip is None else exclude_blocks(df, skip, skip_col, idx)


# DQ-03 -- notes whose word differs from their root's word, plus those roots.
# One join on the block gives every child its root's word; a root is marked
# in one aggregation over the blocks that hold a bad child.
def check_same_word(df: DataFrame, idx: str = "idx", word: str = "word", skip: DataFrame | None = None, skip_col: str | None = None) -> DataFrame:
    """Children without a root are not judged; ``skip[skip_col]`` lists whole
    blocks to leave out."""
    notes = _skip_blocks(df.select(idx, word), idx, skip, skip_col).withColumn("__b", ix.root(idx))
    roots = notes.where(ix.is_root(idx)).select("__b", F.col(word).alias("__rw"), F.col(idx).alias("__ri"))
    kids = notes.where(~ix.is_root(idx))
    bad = kids.join(roots, "__b").where(_differs(word, "__rw"))
    both = F.explode(F.array(F.struct(F.col(idx), F.col(word)), F.struct(F.col("__ri").alias(idx), F.col("__rw").alias(word))))
    return bad.select(both.alias("__x")).select(f"__x.{idx}", f"__x.{word}").distinct()


# DQ-04 -- verbs whose translation lacks "to " (null counts as bad), leaving
# out the whole blocks that ``skip[skip_col]`` lists
def check_verbs(df: DataFrame, key: str, translation: str, pos: str, skip: DataFrame | None = None, skip_col: str | None = None) -> DataFrame:
    """The reserved mark is "to " with its space, so that words such as
    "tomorrow" are not taken for infinitives."""
    t = F.col(translation)
    return _skip_blocks(df.where((F.col(pos) == "verb") & (t.isNull() | ~t.startswith("to "))), key, skip, skip_col)


# DQ-05 -- examples whose word mismatches the deck root, actual word shown
def check_examples(
    examples: DataFrame, deck: DataFrame, idx: str = "idx", word: str = "word", skip: DataFrame | None = None, skip_col: str | None = None
) -> DataFrame:
    d = deck.where(ix.is_root(idx)).select(ix.root(idx).alias("__b"), F.col(word).alias("word_actual"))
    ex = _skip_blocks(examples, idx, skip, skip_col)
    j = ex.join(d, ix.root(ex[idx]) == d["__b"]).drop("__b")
    return j.where(_differs(word, "word_actual"))


# DQ-06 -- keys in one table but not the other, both ways
def diff_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    only_a = a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("side", F.lit("only_a"))
    only_b = b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("side", F.lit("only_b"))
    return only_a.unionByName(only_b)


# DQ-07 -- blocks whose line counts differ between two versions, with 0 for a
# block that one side lacks
def check_block_lengths(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    from .agg import block_mismatch

    x = block_mismatch(a, b, key)
    return x.select(key, F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"))


# DQ-08 -- invalid responses
def check_responses(df: DataFrame, valid_col: str = "valid") -> DataFrame:
    return df.where(~F.coalesce(F.col(valid_col), F.lit(False)))


# DQ-09 -- pages with no content
def check_pages(df: DataFrame, content_cols: list[str]) -> DataFrame:
    cond = None
    for c in content_cols:
        x = F.col(c).isNull() | (F.trim(F.col(c)) == "")
        cond = x if cond is None else cond | x
    return df.where(cond)


# DQ-10 -- unresolved {{placeholders}} after rendering
def check_rendered(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).rlike(r"\{\{[^}]*\}\}"))


# DQ-11 -- texts without a line break
def check_line_breaks(df: DataFrame, col: str) -> DataFrame:
    return df.where(~F.col(col).contains("\n"))


# DQ-12 -- nothing left to generate
def check_pending(pending: DataFrame) -> DataFrame:
    return pending.agg(F.count(F.lit(1)).cast("bigint").alias("n_pending")).withColumn("nothing_left", F.col("n_pending") == 0)


# DQ-13 -- ranks must not decrease along the index, and cards of equal rank
# have consecutive indices.  The predecessor comes from a prefix scan (no
# single-partition lag).
def check_rank_order(df: DataFrame, order: str, rank: str, consecutive: bool = False) -> DataFrame:
    """Offending rows with ``prev_size``, the rank before them; with
    ``consecutive`` also those of the same rank whose index is not the next
    whole number, and with ``prev_index``."""
    from .scan import LAST, prefix_scan

    prev = F.struct(F.col(rank).alias("rank"), F.col(order).alias("index"))
    x = prefix_scan(df, [], [order, rank], {"__prev": (prev, LAST)}, inclusive=False)
    falls = F.col("__prev.rank") > F.col(rank)
    shown = [F.col("__prev.rank").alias("prev_size")]
    if consecutive:
        falls = falls | ((F.col("__prev.rank") == F.col(rank)) & (F.col(order) - F.col("__prev.index") != 1))
        shown.append(F.col("__prev.index").alias("prev_index"))
    return x.where(falls).select(*df.columns, *shown)
