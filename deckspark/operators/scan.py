"""Prefix scans of associative functions, and what follows from them: joins
by the nearest earlier row and by intervals.

Like the running sums of ``window``, a scan never puts a group into one task:
rows are range-partitioned by sampled bounds and written once, each range is
scanned by itself, and the totals of the ranges before it come from a table
of one row per range.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .window import _cols, _ranged, _same

Value = Callable[[Column], Column]


@dataclass(frozen=True)
class Scan:
    """An associative function: ``over`` aggregates the rows of an ordered
    window frame, ``whole`` those of a group (``__n`` is their order), and
    ``join`` two neighbouring results, either of which may be null (nothing)."""

    over: Value
    whole: Value
    join: Callable[[Column, Column], Column]


def _ordered(v: Column) -> Column:
    return F.when(v.isNotNull(), F.col("__n"))


SUM = Scan(F.sum, F.sum, lambda a, b: F.coalesce(a + b, a, b))
MAX = Scan(F.max, F.max, lambda a, b: F.greatest(a, b))
MIN = Scan(F.min, F.min, lambda a, b: F.least(a, b))
LAST = Scan(lambda v: F.last(v, True), lambda v: F.max_by(v, _ordered(v)), lambda a, b: F.coalesce(b, a))
FIRST = Scan(lambda v: F.first(v, True), lambda v: F.min_by(v, _ordered(v)), lambda a, b: F.coalesce(a, b))


@dataclass(frozen=True)
class Associative:
    """Any associative ``join`` of two neighbouring values, given as an
    expression.  Null values count as nothing."""

    join: Callable[[Column, Column], Column]


def prefix_scan(df: DataFrame, keys, order, scans: dict[str, tuple[Column | str, Scan | Associative]], inclusive: bool = True) -> DataFrame:
    """``df`` with, for each ``out: (value, scan)``, the scan of the values of
    the rows of the same ``keys`` up to this one by ``order`` (without this
    one if not ``inclusive``); null where there are none.  ``order`` must be
    total within ``keys`` for a definite result.  One shuffle of the rows.
    Columns named as an ``out`` are replaced."""
    keys, order = _cols(keys), _cols(order)
    value = {out: F.col(v) if isinstance(v, str) else v for out, (v, _) in scans.items()}
    at = {out: f"__v{i}" for i, out in enumerate(scans)}
    t = _ranged(df.withColumns({at[o]: v for o, v in value.items()}), keys, order)
    rows = Window.partitionBy(*keys, "__p").orderBy("__n")
    frame = rows.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    own = {o: s for o, (_, s) in scans.items() if isinstance(s, Associative)}
    ready = {o: s for o, (_, s) in scans.items() if isinstance(s, Scan)}
    x = t.withColumns({f"__l{at[o]}": s.over(F.col(at[o])).over(frame) for o, s in ready.items()})
    totals = [s.whole(F.col(at[o])).alias(f"__t{at[o]}") for o, s in ready.items()]
    if own:
        most = t.groupBy(*keys, "__p").count().agg(F.max("count")).first()[0] or 1
        scanned = _doubled(t, rows, {at[o]: s for o, s in own.items()}, most)
        totals += [F.max_by(f"__d{at[o]}", "__n").alias(f"__t{at[o]}") for o in own]
        x = _doubled(x, rows, {at[o]: s for o, s in own.items()}, most)
        local = lambda o: F.col(f"__d{at[o]}") if inclusive else F.lag(f"__d{at[o]}").over(rows)
        x = x.withColumns({f"__l{at[o]}": local(o) for o in own})
    else:
        scanned = t
    off = _earlier(scanned, t, keys, totals, {at[o]: s for o, (_, s) in scans.items()})
    j = x.join(F.broadcast(off), _same(x, off, keys), "left")  # at most one row per range
    res = {o: _join(s, F.col(f"__o{at[o]}"), F.col(f"__l{at[o]}")) for o, (_, s) in scans.items()}
    return j.select(*[c for c in df.columns if c not in res], *[c.alias(o) for o, c in res.items()])


def _join(s: Scan | Associative, a: Column, b: Column) -> Column:
    if isinstance(s, Scan):
        return s.join(a, b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(s.join(a, b))


def _doubled(x: DataFrame, rows, scans: dict[str, Associative], most: int) -> DataFrame:
    """Inclusive scans ``__d*`` of groups of at most ``most`` rows: after k
    steps a row has joined the 2^k rows up to it.  All steps share one sort."""
    x = x.withColumns({f"__d{v}": F.col(v) for v in scans})
    for k in range(math.ceil(math.log2(most)) if most > 1 else 0):
        x = x.withColumns({f"__d{v}": _join(s, F.lag(f"__d{v}", 1 << k).over(rows), F.col(f"__d{v}")) for v, s in scans.items()})
    return x


def _earlier(scanned: DataFrame, t: DataFrame, keys: list, totals: list[Column], scans: dict[str, Scan | Associative]) -> DataFrame:
    """``__o*``: the scan of all earlier ranges of a group, for the ranges
    that begin inside a group (a range's first group only)."""
    if keys:
        first = t.where("__n = 0").select(*[F.col(k).alias(f"{k}_") for k in keys]).distinct()
        on = None
        for k in keys:
            c = scanned[k].eqNullSafe(first[f"{k}_"])
            on = c if on is None else on & c
        scanned = scanned.join(F.broadcast(first), on, "left_semi")  # at most one row per range
    sums = scanned.groupBy(*keys, "__p").agg(*totals)
    ranges = Window.partitionBy(*keys).orderBy("__p")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    own = {v: s for v, s in scans.items() if isinstance(s, Associative)}
    if own:
        sums = cut_lineage(sums, "range-totals")  # at most two rows per range
        sums = sums.withColumns({v: F.col(f"__t{v}") for v in own})
        sums = _doubled(sums, ranges, own, max(1, sums.count()))
    offs = {v: s.over(F.col(f"__t{v}")).over(before) if isinstance(s, Scan) else F.lag(f"__d{v}").over(ranges) for v, s in scans.items()}
    nth = F.row_number().over(ranges).alias("__nth")
    return sums.select(
        *[F.col(k).alias(f"{k}_") for k in keys], F.col("__p").alias("__p_"), nth, *[c.alias(f"__o{v}") for v, c in offs.items()]
    ).where("__nth > 1")


# As-of join: each left row with the nearest right row at or before it
def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by=None,
    direction: str = "backward",
    exact: bool = True,
    tolerance: Column | None = None,
    order=None,
    suffix: str = "_r",
) -> DataFrame:
    """``left`` with the columns of ``right`` (but ``by``) under ``suffix``:
    those of the last right row of the same ``by`` whose ``on`` is at or
    before (``direction="backward"``) or the first at or after (``"forward"``)
    the left row's; ``exact=False`` leaves out equal values.  Of right rows
    with the same ``on`` the nearest by ``order`` is taken (the last backward,
    the first forward), so ``order`` makes it definite.  ``tolerance`` bounds
    the distance.  Null ``on`` matches nothing; null ``by`` meets null."""
    by, order = _cols(by), _cols(order)
    cols = [c for c in right.columns if c not in by]
    kept = F.struct(*[F.col(c) for c in cols])
    rank = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    # probes follow equal values where these count, and precede them otherwise
    a = left.select(*by, F.col(on).alias("__on"), F.lit(exact).alias("__probe"), F.lit(True).alias("__left"), F.struct("*").alias("__row"))
    b = right.where(F.col(on).isNotNull()).select(
        *by, F.col(on).alias("__on"), F.lit(not exact).alias("__probe"), F.lit(False).alias("__left"), kept.alias("__kept"), rank.alias("__rank")
    )
    both = a.unionByName(b, allowMissingColumns=True)
    if direction == "backward":
        sort = [F.col("__on").asc_nulls_first(), F.col("__probe").asc(), F.col("__rank").asc_nulls_first()]
    elif direction == "forward":
        sort = [F.col("__on").desc_nulls_first(), F.col("__probe").asc(), F.col("__rank").desc_nulls_first()]
    else:
        raise ValueError(f"unknown direction {direction}")
    x = prefix_scan(both, by, sort, {"__near": ("__kept", LAST)}).where("__left")
    near = F.when(F.col("__on").isNotNull(), F.col("__near"))
    if tolerance is not None:
        apart = F.col("__on") - F.col(f"__near.{on}") if direction == "backward" else F.col(f"__near.{on}") - F.col("__on")
        near = F.when(apart <= tolerance, near)
    return x.select("__row", near.alias("__near")).select("__row.*", *[F.col(f"__near.{c}").alias(c + suffix) for c in cols])


# JN-11, general -- points in intervals, by rank
RUN = 4096  # ranks of an interval that are expanded in one go


def interval_join(points: DataFrame, intervals: DataFrame, point: str, lo: str, hi: str, by=None) -> DataFrame:
    """All pairs with ``lo <= point < hi`` (and equal ``by``): the columns of
    both, those of ``by`` once.

    Points are numbered in order and every interval learns the numbers of the
    points it holds, both by one running count over points and bounds; an
    interval is then expanded to exactly those numbers and meets the points by
    an equi-join.  There is no bin width to choose: neither dense places, nor
    long intervals, nor a value that many points share cost more than the
    pairs they give.  Null points and bounds match nothing; repeated rows each
    count; a null ``by`` meets null."""
    from .window import running_sum

    by = _cols(by)
    own = [c for c in intervals.columns if c not in by]
    clash = set(points.columns) & set(own)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a = points.where(F.col(point).isNotNull()).select(*by, F.col(point).alias("__x"), F.lit(1).alias("__is"), F.struct("*").alias("__row"))
    ends = F.explode(F.array(F.struct(F.lit("lo").alias("end"), F.col(lo).alias("x")), F.struct(F.lit("hi").alias("end"), F.col(hi).alias("x"))))
    ranges = cut_lineage(intervals.where(F.col(lo) < F.col(hi)).withColumn("__id", F.monotonically_increasing_id()), "intervals")
    b = ranges.select("__id", *by, ends.alias("__e")).select("__id", *by, F.col("__e.x").alias("__x"), F.lit(0).alias("__is"), F.col("__e.end").alias("__end"))
    # bounds precede equal points: each counts the points before it
    both = a.unionByName(b, allowMissingColumns=True)
    tie = F.xxhash64("__row", "__id")
    counted = cut_lineage(running_sum(both.withColumn("__tie", tie), by, ["__x", "__is", "__tie"], F.col("__is").cast("long"), "__rank"), "ranks")
    end = lambda e: F.max(F.when(F.col("__end") == e, F.col("__rank")))
    held = counted.where("__is = 0").groupBy("__id").agg(end("lo").alias("__a"), end("hi").alias("__b")).where("__a < __b")
    # the numbers a+1 .. b, a run at a time, so that no long list is made
    runs = held.select("__id", "__b", F.explode(F.sequence(F.col("__a") + 1, F.col("__b"), F.lit(RUN).cast("long"))).alias("__from"))
    few = F.sequence(F.col("__from"), F.least(F.col("__b"), F.col("__from") + (RUN - 1)))
    pairs = runs.select("__id", F.explode(few).alias("__rank")).join(ranges, "__id")
    numbered = counted.where("__is = 1").select("__rank", "__row", *[F.col(k).alias(f"__by_{k}") for k in by])
    on = pairs["__rank"] == numbered["__rank"]
    for k in by:
        on = on & pairs[k].eqNullSafe(numbered[f"__by_{k}"])
    return pairs.join(numbered, on).select("__row.*", *own)
