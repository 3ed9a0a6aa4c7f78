"""Sorts, limits and samples (OR-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import index as ix


def sort_index(df: DataFrame, idx: str = "idx") -> DataFrame:
    return df.orderBy(idx)


# OR-02 / UDF-04 -- the deck comparator as a sort-key expression
def deck_order(df: DataFrame, idx: str = "idx", *tie) -> DataFrame:
    return df.orderBy(*ix.deck_order_key(idx), *tie)


# OR-03 -- complete rows first, each part by index
def complete_first(df: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    return df.orderBy(F.col(col).isNull(), F.col(idx))


def seeded_hash(key: str, seed: int) -> Column:
    """A shuffle order that any engine can repeat."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


# OR-06 -- deterministic shuffle and take n: order by a seeded hash.  The
# top-n is taken per partition first (TakeOrderedAndProject), so only n rows
# per task reach the final merge.
def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    h = seeded_hash(key, seed)
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


# OR-07 -- first n rows in a given order (preview)
def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


# OR-08 -- text keys sorted as numbers
def order_numeric(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col(col).try_cast("bigint"), F.col(col))


# OR-09 -- reverse index order
def reverse_index(df: DataFrame, idx: str = "idx") -> DataFrame:
    return df.orderBy(F.col(idx).desc())


# OR-10
def by_length(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.char_length(col), col)
