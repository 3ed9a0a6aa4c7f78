"""Ordered and windowed operators (WN-*) plus skew-safe numbering.

Running sums and row numbers never put a group into one task:

1. rows are range-partitioned by (group, order); Spark samples the bounds,
   so the ranges follow the density of the data and a hot group is spread
   over as many of them as it needs;
2. the ranges are written once as a table with each row's place, and all
   further steps read that table: the input is read once;
3. sums are local to (group, range); the sums of earlier ranges are added
   from a table with at most one row per range, since only a range's first
   group can begin in an earlier one.

Null groups and null order values are kept and sort first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import index as ix
from ..session import cut_lineage

_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its range
_CHUNK_BITS = 16  # of these: the row's place in a chunk of its range
PACK_ROWS, PACK_BYTES = 4096, 8 << 20  # of a pack of rows, at most


def _cols(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


def _ranged(df: DataFrame, keys: list, order: list) -> DataFrame:
    """``df`` written in the order of keys and ``order``, with ``__p`` (range)
    and ``__n`` (place in it, from 0)."""
    by = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in [*keys, *order]]
    at = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", at)
    p = F.shiftright("__at", _ROW_BITS).cast("int")
    n = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return cut_lineage(ordered.withColumn("__p", p).withColumn("__n", n).drop("__at"), "ordered", "zstd")


def _same(a: DataFrame, b: DataFrame, keys: list) -> Column:
    on = a["__p"] == b["__p_"]
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"{k}_"])
    return on


def _add_earlier(x: DataFrame, t: DataFrame, keys: list, sums: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``x`` with each ``out: (local, value)`` of ``sums`` as the local sum
    plus the sums of the group's earlier ranges."""
    if keys:
        first = t.where("__n = 0").select(*[F.col(k).alias(f"{k}_") for k in keys]).distinct()
        on = None
        for k in keys:
            c = t[k].eqNullSafe(first[f"{k}_"])
            on = c if on is None else on & c
        part = t.join(F.broadcast(first), on, "left_semi")  # at most one row per range
    else:
        part = t
    totals = part.groupBy(*keys, "__p").agg(*[F.sum(value).alias(f"__tot_{out}") for out, (_, value) in sums.items()])
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__p"))
    offs = [F.sum(f"__tot_{out}").over(before).alias(f"__off_{out}") for out in sums]
    off = totals.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("__p").alias("__p_"), nth.alias("__nth"), *offs).where("__nth > 1")
    j = x.join(F.broadcast(off), _same(x, off, keys), "left")  # at most one row per range
    res = [(F.coalesce(F.col(f"__off_{out}"), F.lit(0)) + local).alias(out) for out, (local, _) in sums.items()]
    return j.select("*", *res)


def running_sums(df: DataFrame, keys, order, values: dict[str, Column | str], inclusive: bool = True) -> DataFrame:
    """For each ``out: value``, ``sum(value)`` over rows of the same ``keys``
    ordered by ``order``, which must be a total order within ``keys``.  Keys
    are column names; order may hold expressions such as ``F.col(c).desc()``."""
    keys, order = _cols(keys), _cols(order)
    names = {out: f"__v{i}" for i, out in enumerate(values)}
    val = {names[o]: F.col(v) if isinstance(v, str) else v for o, v in values.items()}
    t = _ranged(df.withColumns(val), keys, order)
    frame = Window.partitionBy(*keys, "__p").orderBy("__n").rowsBetween(Window.unboundedPreceding, 0)
    x = t.withColumns({f"__local{v}": F.sum(v).over(frame) for v in val})
    j = _add_earlier(x, t, keys, {f"__sum{v}": (F.col(f"__local{v}"), F.col(v)) for v in val})
    res = {o: F.col(f"__sum{v}") if inclusive else F.col(f"__sum{v}") - F.coalesce(F.col(v), F.lit(0)) for o, v in names.items()}
    return j.select(*[c for c in df.columns if c not in res], *[c.alias(o) for o, c in res.items()])


def running_sum(df: DataFrame, keys, order, value: Column | str, out: str, inclusive: bool = True) -> DataFrame:
    """:func:`running_sums` of one value."""
    return running_sums(df, keys, order, {out: value}, inclusive)


def number_rows(df: DataFrame, keys, order, out: str = "row_number") -> DataFrame:
    """WN-04 / OR-12: 1-based row numbers within ``keys`` (global if none),
    without funnelling a group through one task.  Global numbers follow from
    each row's place in its range and need no window over the rows."""
    keys, order = _cols(keys), _cols(order)
    one = F.lit(1).cast("bigint")
    if keys:
        return running_sum(df, keys, order, one, out)
    t = _ranged(df, [], order)
    j = _add_earlier(t, t, [], {"__sum": (F.col("__n") + 1, one)})
    return j.select(*[c for c in df.columns if c != out], F.col("__sum").alias(out))


# WN-01 -- n-th occurrence of an index gets +step*n (n from 0)
def suffix_occurrences(df: DataFrame, idx: str, order, step: str = "0.001", out: str | None = None) -> DataFrame:
    out = out or idx
    numbered = number_rows(df, [idx], order, "__occ")
    return numbered.withColumn(out, ix.suffix(F.col(idx), F.col("__occ") - 1, step)).drop("__occ")


def neighbours(df: DataFrame, keys, order, cols: list[str], before: int, after: int, number: str | None = None) -> DataFrame:
    """``df`` with ``__before`` and ``__after``: arrays of the ``cols`` of the
    ``before`` rows before and ``after`` rows after each, nearest first, null
    where the group of ``keys`` ends.  A row is sent to its range once; what a
    range's borders need comes from a table of one row per range.  Every row
    comes back, whatever its keys and order hold.  ``number`` names a column
    for the row's number in the order of keys and ``order``, which comes free."""
    keys, order = _cols(keys), _cols(order)
    t = _ranged(df, keys, order)
    # __q: chunks of a range, dealt evenly to the tasks; __m: place in a chunk
    at = F.shiftleft(F.col("__p").cast("long"), _ROW_BITS).bitwiseOR(F.col("__n"))
    t = t.withColumns({"__q": F.shiftright(at, _CHUNK_BITS), "__m": at.bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1))}).drop("__p", "__n")
    size = t.groupBy("__q").agg(F.count(F.lit(1)).alias("__size"))
    # the first and last rows of each chunk: a few rows per chunk
    first, last = F.col("__m") < after, F.col("__m") >= F.col("__size") - before
    pair = lambda of: F.struct(F.struct(*[of(k).alias(k) for k in keys]).alias("k"), F.struct(*[of(c).alias(c) for c in cols]).alias("v"))
    place = F.struct(F.col("__m").alias("n"), pair(F.col).alias("x"))
    ends = t.join(F.broadcast(size), "__q").where(first | last).groupBy("__q", "__size").agg(
        F.array_sort(F.collect_list(F.when(first, place))).alias("__head"), F.array_sort(F.collect_list(F.when(last, place))).alias("__tail")
    )
    chunks = Window.orderBy("__q")  # one row per chunk
    over = lambda c, a, b: F.transform(F.flatten(F.collect_list(c).over(chunks.rowsBetween(a, b))), lambda e: e["x"])
    sides = [over("__tail", -before, -1).alias("__earlier")] * (before > 0) + [over("__head", 1, after).alias("__later")] * (after > 0)
    if number:
        sides.append(F.coalesce(F.sum("__size").over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    edges = ends.select("__q", "__size", *sides)
    # plain columns only are sent to a chunk; what they make is put together there
    rows = Window.partitionBy("__q").orderBy("__m")
    steps = [*range(-before, 0), *range(1, after + 1)]
    names = {(c, s): f"__w{i}_{s + before}" for i, c in enumerate(dict.fromkeys([*keys, *cols])) for s in steps}
    got = t.withColumns({name: F.lag(c, -s).over(rows) if s < 0 else F.lead(c, s).over(rows) for (c, s), name in names.items()})
    j = got.join(F.broadcast(edges), "__q")

    def near(step: int) -> Column:
        """The row ``step`` rows on (back, if negative)."""
        inside = pair(lambda c: F.col(names[c, step]))
        if step < 0:
            n = F.col("__m") + step
            outside = F.try_element_at("__earlier", F.when(n < 0, n).otherwise(-1).cast("int"))
            found = F.when(n >= 0, inside).otherwise(outside)
        else:
            n = F.col("__m") + step - F.col("__size") + 1
            outside = F.try_element_at("__later", F.when(n > 0, n).otherwise(1).cast("int"))
            found = F.when(n <= 0, inside).otherwise(outside)
        return F.when(found["k"].eqNullSafe(F.struct(*[F.col(k) for k in keys])), found["v"])

    both = [F.array(*[near(-s) for s in range(1, before + 1)]).alias("__before"), F.array(*[near(s) for s in range(1, after + 1)]).alias("__after")]
    nth = [(F.col("__off") + F.col("__m") + 1).alias(number)] if number else []
    return j.select(*df.columns, *both, *nth)


# WN-02 -- previous / next element within a group, "" at the edges
def with_context(df: DataFrame, key: str, pos: str, cols: list[str], blank: str = "", number: str | None = None, heads: DataFrame | None = None) -> DataFrame:
    """Rows of one ``key`` in the order of ``pos``, nulls first; rows with
    the same ``pos`` are ordered by ``cols``.  ``number`` names a column for
    the row's number in this order over all keys.

    The rows are sent to their range once and written there in packs; a pack
    holds its rows' neighbours but for those of its first and last row, which
    come from a table of one row per pack.

    ``heads`` (``key`` and other columns) is left-joined by ``key`` once the
    rows are numbered: its rows go in front of their key's, so that no row is
    sent again."""
    kind = df.schema[key].dataType
    if heads is not None and (heads.schema[key].dataType != kind or isinstance(kind, T.FractionalType)):
        return with_context(df, key, pos, cols, blank, number).join(heads, key, "left")
    lines, titles = df, []
    if heads is not None:
        titles = [c for c in heads.columns if c != key]
        each = heads.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*titles)).alias("__heads"))
        lines = df.withColumn("__line", F.lit(True)).unionByName(each.withColumn("__line", F.lit(False)), allowMissingColumns=True)
    by = [F.col(c).asc_nulls_first() for c in dict.fromkeys([key, *["__line"] * bool(titles), pos, *cols])]
    packed = _packed(lines.repartitionByRange(*by).sortWithinPartitions(*by), key if titles else None)
    ends = lambda at: F.struct(*[F.get(c, at).alias(c) for c in dict.fromkeys([key, *cols])])
    size = F.size(key)
    packed = packed.withColumns({"__c": F.monotonically_increasing_id(), "__size": size, "__first": ends(F.lit(0)), "__last": ends(size - 1)})
    t = cut_lineage(packed, "packed", "zstd")
    packs = Window.orderBy("__c")  # one row per pack
    before = packs.rowsBetween(Window.unboundedPreceding, -1)
    head = lambda: F.last(F.when(F.col("__head")[key].isNotNull(), F.col("__head")), True).over(before).alias("__head")
    edges = t.select("__c", "__size", "__first", "__last", *[head() for _ in titles[:1]]).where("__size > 0")
    off = F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__off")
    edges = edges.select("__c", off, F.lag("__last").over(packs).alias("__earlier"), F.lead("__first").over(packs).alias("__later"), *["__head"] * bool(titles))
    j = t.select("__c", "__size", *[c for c in packed.columns if not c.startswith("__") or c == "__heads"]).join(F.broadcast(edges), "__c")
    rest = F.col("__size") - 1
    prev = lambda c: F.concat(F.array(F.col("__earlier")[c]), F.slice(c, F.lit(1), rest)).alias(f"__prev_{c}")
    later = lambda c: F.concat(F.slice(c, F.lit(2), rest), F.array(F.col("__later")[c])).alias(f"__next_{c}")
    near = [side(c) for side in (prev, later) for c in dict.fromkeys([key, *cols])]
    kept = ["__off", *["__head"] * bool(titles)]
    rows = j.select(*kept, *df.columns, *["__heads"] * bool(titles), *near)
    x = rows.select(*kept, F.posexplode(F.arrays_zip(*[c for c in rows.columns if c not in kept])).alias("__n", "__row")).select(*kept, "__n", "__row.*")
    if titles:  # those of a key that began in an earlier range come from there
        own = F.coalesce("__heads", F.when(F.col("__head")[key] == F.col(key), F.col("__head.heads")))
        x = x.select("*", F.explode_outer(own).alias("__t"))
    of = lambda c, d: F.when(F.col(f"__{d}_{key}").eqNullSafe(F.col(key)), F.col(f"__{d}_{c}"))
    side = lambda c, d: F.coalesce(of(c, d), F.lit(blank)).alias(f"{c}_{d}")
    nth = [(F.col("__off") + F.col("__n") + 1).alias(number)] if number else []
    return x.select(*df.columns, *[side(c, "prev") for c in cols], *[side(c, "next") for c in cols], *nth, *[F.col("__t")[c].alias(c) for c in titles])


def _packed(ordered: DataFrame, key: str | None = None) -> DataFrame:
    """The columns of ``ordered`` as arrays: packs of rows that follow each
    other, in their order.  A pack is a row, so it is read by one task.

    With ``key``, rows that are no ``__line`` hold the ``__heads`` of the lines
    of their key that follow.  These get a copy; the last pack of a batch, which
    may be empty, has the last ``__head`` up to its end."""
    fields = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in ordered.schema if f.name != "__line"]
    if key:
        types = {c: ordered.schema[c].dataType for c in (key, "__heads")}
        fields.append(T.StructField("__head", T.StructType([T.StructField(key, types[key]), T.StructField("heads", types["__heads"])])))

    def with_heads(batches):
        last = None
        for b in batches:
            if last is None:
                last = [pa.nulls(1, b.column(c).type) for c in (key, "__heads")]
            keys, heads = (pa.concat_arrays([x, b.column(c)]) for x, c in zip(last, (key, "__heads")))
            line = b.column("__line").to_numpy(zero_copy_only=False)
            at = np.maximum.accumulate(np.where(line, 0, np.arange(1, len(line) + 1)))  # the head before each row
            lines = np.flatnonzero(line)
            own = pc.fill_null(pc.equal(keys.take(pa.array(at[lines])), b.column(key).take(pa.array(lines))), False).to_numpy(zero_copy_only=False)
            copies = heads.take(pa.array(at[lines], mask=~own))
            last = [x.take(pa.array(at[-1:])) for x in (keys, heads)]
            part = b.take(pa.array(lines))
            names = [c for c in part.schema.names if c != "__line"]
            yield pa.RecordBatch.from_arrays([copies if c == "__heads" else part.column(c) for c in names], names=names), last

    def run(batches):
        for b, last in with_heads(b for b in batches if b.num_rows) if key else ((b, None) for b in batches):
            n = max(1, min(PACK_ROWS, b.num_rows * PACK_BYTES // max(1, b.nbytes)))
            for at in range(0, max(b.num_rows, 1 if key else 0), n):
                part = b.slice(at, n)
                ends = pa.array([0, part.num_rows], pa.int32())
                columns = [pa.ListArray.from_arrays(ends, c) for c in part.columns]
                if key:
                    head = pa.StructArray.from_arrays(last, names=[key, "heads"])
                    columns.append(head if at + n >= b.num_rows else pa.nulls(1, head.type))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return ordered.mapInArrow(run, T.StructType(fields))


# WN-03 -- start / end line offset of every story (exclusive running sum)
def line_offsets(sizes: DataFrame, order: str, size: str) -> DataFrame:
    x = running_sum(sizes, [], order, F.col(size).cast("bigint"), "start_line", inclusive=False)
    return x.withColumn("end_line", F.col("start_line") + F.col(size))


# WN-06 -- position inside a group
def positions(df: DataFrame, keys, arr: str, pos: str = "pos", value: str = "value", base: int = 1) -> DataFrame:
    keys = _cols(keys)
    return df.select(*keys, F.posexplode(arr).alias(pos, value)).withColumn(pos, (F.col(pos) + base).cast("bigint"))


# WN-08 -- +-margin context around each line (blank beyond the ends)
def with_margins(df: DataFrame, key: str, pos: str, col: str, margin: int, blank: str = "") -> DataFrame:
    near = neighbours(df, [key], [pos, col], [col], margin, margin)
    text = lambda arr: F.transform(arr, lambda x: F.coalesce(x[col], F.lit(blank)))
    return near.select(*df.columns, F.reverse(text("__before")).alias("before"), text("__after").alias("after"))


# WN-09 -- consecutive fixed-size blocks of `size` rows, at most max_blocks
def fixed_blocks(df: DataFrame, order, size: int, max_blocks: int | None = None) -> DataFrame:
    x = number_rows(df, [], order, "__rn").withColumn("block", F.floor((F.col("__rn") - 1) / size).cast("bigint"))
    if max_blocks is not None:
        x = x.where(F.col("block") < max_blocks)
    return x.drop("__rn")


# WN-10 -- round-robin assignment to k workers
def assign_round_robin(df: DataFrame, block: str, k: int, out: str = "worker") -> DataFrame:
    return df.withColumn(out, F.pmod(F.col(block), F.lit(k)).cast("int"))


# WN-13 -- line range [start ; end) of every block from block sizes
def block_ranges(blocks: DataFrame, order: str, size: str) -> DataFrame:
    x = running_sum(blocks, [], order, F.col(size).cast("bigint"), "start", inclusive=False)
    return x.withColumn("end", F.col("start") + F.col(size))


# WN-05 -- next free suffix for each translation that has no card yet:
# block max + 0.001*k (k = 1, 2, ...), flagged when it reaches 0.01.
def missing_meanings(deck: DataFrame, wanted: DataFrame, idx: str = "idx", word: str = "translation") -> DataFrame:
    """``wanted`` holds (block, translation) pairs a root should have cards
    for; pairs already present in the deck are dropped; the rest are numbered
    per block after the block's current maximum index."""
    have = deck.select(ix.root(idx).alias("block"), F.col(word).alias("translation"))
    missing = wanted.join(have, ["block", "translation"], "left_anti").distinct()
    bmax = deck.groupBy(ix.root(idx).alias("block")).agg(F.max(idx).alias("block_max"))
    numbered = number_rows(missing, ["block"], ["translation"], "__k")
    res = numbered.join(bmax, "block").withColumn(
        "new_idx", ix.suffix(F.col("block_max"), F.col("__k"), "0.001")
    )
    return res.withColumn("overflow", ix.frac("new_idx") >= ix.dec("0.01")).drop("__k")
