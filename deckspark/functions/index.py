"""Fractional card index arithmetic (MTH-*, FL-07..09, OR-02 key, DQ-02).

The index is ``decimal(18,6)``: integer part = root note, ``+0.001*n`` =
alternative meaning, ``+0.0001*n`` = user-added word, fraction < 0.01.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import IDX_SQL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_idx(c) -> Column:
    return _c(c).cast(IDX_SQL)


def dec(v) -> Column:
    return F.lit(Decimal(str(v))).cast(IDX_SQL)


# MTH-01
def root(c) -> Column:
    return F.floor(_c(c)).cast("bigint")


def frac(c) -> Column:
    return (_c(c) - F.floor(_c(c))).cast(IDX_SQL)


# MTH-02 -- decimal rounding is exact (no binary drift), HALF_UP
def round_idx(c, n: int) -> Column:
    return F.round(_c(c), n).cast(IDX_SQL)


# MTH-04 -- leading zeros of the fraction (0.001 -> 2); -1 for a whole number
def leading_zeros(c) -> Column:
    f = frac(c)
    s = f.cast("string")
    return F.when(f == 0, F.lit(-1)).otherwise(F.char_length(F.regexp_extract(s, r"\.(0*)", 1))).cast("int")


# FL-07
def is_root(c) -> Column:
    return _c(c) == F.floor(_c(c))


# FL-08 -- user-added word: 0.0001 <= round(frac, 4) < 0.001
def is_custom_note(c, strict_zero: bool = False) -> Column:
    f = F.round(frac(c), 4)
    if strict_zero:  # custom-deck variant: 0 < frac < 0.001
        return (f > 0) & (f < dec("0.001"))
    return (f >= dec("0.0001")) & (f < dec("0.001"))


# FL-09
def block_of(c) -> Column:
    return root(c)


# DQ-02 helper
def fraction_at_least(c, bound="0.01") -> Column:
    return frac(c) >= dec(bound)


# OR-02 -- deck order key: root, then fractions by order of magnitude
# ascending, then by value.  Whole numbers come first in their block.
def deck_order_key(c) -> list[Column]:
    """Sort key equivalent to the reference comparator: for the same root,
    0 < 0.01 < 0.013 < 0.001 < 0.0013 < 0.0001 (fewer leading zeros first,
    then by value)."""
    return [root(c), leading_zeros(c), frac(c)]


# MTH-03
def ceil_div(a, b) -> Column:
    return F.ceil(_c(a) / _c(b)).cast("bigint")


# STR-16 / STR-17 live in functions.text; WN-01 step helper
def suffix(c, n, step="0.001") -> Column:
    return (_c(c) + _c(n).cast(IDX_SQL) * dec(step)).cast(IDX_SQL)
