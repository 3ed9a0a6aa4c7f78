"""Projections that reshape a table's columns or lines (PJ-06, PJ-08, PJ-09,
FL-10, OR-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import IDX


# PJ-06 -- a new column at a position (0 is the first)
def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    cols = df.columns
    return df.select(*cols[:position], value.alias(name), *cols[position:])


# PJ-08 -- a column becomes the deck's index, and back to a plain column
def promote_index(df: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    return df.select(F.col(col).cast(IDX).alias(idx), *[c for c in df.columns if c not in (col, idx)])


def demote_index(df: DataFrame, name: str, dtype: str = "bigint", idx: str = "idx") -> DataFrame:
    """The index as a column of its own type at the end."""
    return df.select(*[c for c in df.columns if c not in (idx, name)], F.col(idx).cast(dtype).alias(name))


# PJ-09 -- every text column stripped
def trim_all(df: DataFrame) -> DataFrame:
    return df.select(*[strip(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


# FL-10 -- lines lo..hi of each text; hi is cut at the text's last line by
# itself, since later positions do not exist
def line_range(df: DataFrame, pos: str, lo: int, hi: int | None = None) -> DataFrame:
    cond = F.col(pos) >= lo
    return df.where(cond if hi is None else cond & (F.col(pos) <= hi))


# OR-04 -- rows in the order of the first condition they meet, then by `order`
def group_order(df: DataFrame, conditions: list[Column], order: list) -> DataFrame:
    return df.orderBy(group_rank(conditions), *order)


def group_rank(conditions: list[Column]) -> Column:
    """0 for the first condition that holds, ...; the last rank for none."""
    rank = F.lit(len(conditions))
    for i, c in reversed(list(enumerate(conditions))):
        rank = F.when(F.coalesce(c, F.lit(False)), F.lit(i)).otherwise(rank)
    return rank
