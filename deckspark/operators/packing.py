"""WN-07: greedy packing of consecutive lines into translation blocks.

Rule (positions are in the padded sequence: ``margin`` blank lines, the
stripped lines, ``margin`` blank lines; every line costs ``len + 1``):
walking k from ``margin`` to ``n + margin``, a block closes at k when the
running symbols plus the cost of lines ``k .. k+margin+1`` exceed the limit;
it spans ``[start, k + margin]`` and the next block starts at
``k + 1 - margin`` with the cost of its ``margin`` leading lines.  The last
step always closes the open block, so a trailing block may hold only margin
lines.

The rule is sequential, but a block's end follows from its start alone: it
closes where the running cost first exceeds the limit, which a search in the
prefix sums of the costs finds.  So every position knows where the next block
would start if one started there, and the starts that occur are those that
the first one reaches: found by doubling these pointers, all as joins
(:func:`_jump`).  No text is gathered anywhere, and a text of B blocks takes
log2(B) rounds.

Texts of at most ``fold_lines`` lines take a shorter way to the same blocks:
a group of that many pairs of numbers is gathered and folded in the JVM
(:func:`_fold`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import cut_lineage
from .scan import asof_join
from .window import number_rows, running_sums

FOLD_LINES = 50_000


def pack_blocks(lines: DataFrame, key: str, pos: str, line: str, max_symbols: int = 3000, margin: int = 3, fold_lines: int = FOLD_LINES) -> DataFrame:
    """Returns ``(key, block, start, end)``; ``start``/``end`` are inclusive
    positions in the padded sequence (line ``pos`` sits at ``pos - 1 +
    margin`` for 1-based ``pos``).  Lines are taken in the order of ``pos``
    (nulls first), those of equal ``pos`` by length; lines with a null key
    form one text; a null line counts as an empty one."""
    cost = (F.coalesce(F.char_length(strip(F.col(line))), F.lit(0)) + 1).cast("bigint")
    slim = lines.select(F.col(key).alias("__key"), F.col(pos).cast("bigint").alias("p"), cost.alias("c"))
    # one row per text that is too long to be gathered
    long_ = cut_lineage(slim.groupBy("__key").count().where(F.col("count") > fold_lines).select(F.col("__key").alias("__long")), "long-texts")
    if long_.isEmpty():
        out = _fold(slim, max_symbols, margin)
    else:
        on = F.col("__key").eqNullSafe(F.col("__long"))
        apart = _jump(slim.join(long_, on, "left_semi"), max_symbols, margin)
        out = _fold(slim.join(long_, on, "left_anti"), max_symbols, margin).unionByName(apart)
    return out.withColumnRenamed("__key", key)


def _jump(slim: DataFrame, max_symbols: int, margin: int) -> DataFrame:
    """Blocks of all texts by pointer doubling."""
    m = margin
    padding = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(i).cast("bigint").alias("p")) for s in (0, 2) for i in range(m)])).alias("__x") if m else None
    keys = slim.select("__key").distinct()
    padded = slim.select("__key", F.lit(1).alias("s"), "p", "c")
    if m:
        blank = keys.select("__key", padding).select("__key", "__x.s", "__x.p", F.lit(1).cast("bigint").alias("c"))
        padded = padded.unionByName(blank)
    # e: how many padded lines up to this one; pre: what they cost
    one = F.lit(1).cast("bigint")
    upto = cut_lineage(running_sums(padded, ["__key"], ["s", "p", "c"], {"e": one, "pre": "c"}).select("__key", "s", "e", "pre"), "pack-sums")
    size = cut_lineage(upto.groupBy("__key").agg((F.max("e") - 2 * m).alias("n")), "pack-sizes")
    # a block that starts at s closes where the cost first exceeds that
    # before s and the limit; the first block does not count its margin
    first = size.select("__key", F.lit(0).cast("bigint").alias("s"), F.lit(max_symbols + m).cast("bigint").alias("pre"))
    later = upto.select("__key", F.col("e").alias("s"), (F.col("pre") + max_symbols).alias("pre"))
    ends = upto.select("__key", "e", "pre")
    found = asof_join(first.unionByName(later), ends, "pre", by="__key", direction="forward", exact=False, order="e")
    k = F.greatest(F.col("s") + m, F.col("e_r") - (m + 2))
    sized = size.select(F.col("__key").alias("__k2"), "n")
    hops = found.where("e_r is not null").join(sized, F.col("__key").eqNullSafe(F.col("__k2"))).withColumn("k", k).where(F.col("k") <= F.col("n") + m)
    hops = cut_lineage(hops.select("__key", "s", (F.col("k") + 1 - m).alias("to"), (F.col("k") + m).alias("end")), "pack-hops")

    def follow(a: DataFrame, jumps: DataFrame) -> DataFrame:
        """Where the rows of ``a`` (__key, .., at) get in one jump."""
        b = jumps.select(F.col("__key").alias("__kj"), F.col("s").alias("__sj"), F.col("to").alias("__to"))
        # as many rows as blocks: not for the driver to send around
        j = a.join(b.hint("merge"), F.col("__key").eqNullSafe(F.col("__kj")) & (F.col("at") == F.col("__sj")))
        return j.select(*[c for c in a.columns if c != "at"], F.col("__to").alias("at"))

    # after r rounds: all starts of fewer than 2^r hops, and jumps of 2^r hops
    starts = size.select("__key", F.lit(0).cast("bigint").alias("at"))
    jumps = hops.select("__key", "s", "to")
    while not jumps.isEmpty():
        starts = cut_lineage(starts.unionByName(follow(starts, jumps)), "pack-starts")
        twice = follow(jumps.select("__key", "s", F.col("to").alias("at")), jumps)
        jumps = cut_lineage(twice.select("__key", "s", F.col("at").alias("to")), "pack-jumps")
    # a start without a hop opens its text's last block
    closed = hops.select(F.col("__key").alias("__k3"), F.col("s").alias("__s3"), "end")
    blocks = starts.join(sized, F.col("__key").eqNullSafe(F.col("__k2"))).drop("__k2")
    blocks = blocks.join(closed.hint("merge"), F.col("__key").eqNullSafe(F.col("__k3")) & (F.col("at") == F.col("__s3")), "left")
    numbered = number_rows(blocks.select("__key", F.col("at").alias("start"), F.coalesce("end", F.col("n") + 2 * m).alias("end")), ["__key"], ["start"], "nth")
    return numbered.select("__key", (F.col("nth") - 1).alias("block"), "start", "end")


def _fold(slim: DataFrame, max_symbols: int, margin: int) -> DataFrame:
    """Blocks of texts of bounded size.

    The fold runs inside the JVM: one ``groupBy`` gathers each text's line
    costs in order, and ``aggregate`` walks them with the state (symbols,
    block start, borders); the look-ahead is a sum over a ``slice`` of at
    most ``margin + 2`` costs.  No Python worker is involved."""
    m = margin
    per_text = slim.select("__key", F.struct("p", "c").alias("__pc")).groupBy("__key").agg(F.sort_array(F.collect_list("__pc")).alias("__pcs"))
    pad = F.array_repeat(F.lit(1).cast("bigint"), m)
    cost = F.concat(pad, F.transform("__pcs", lambda x: x["c"]), pad)
    x = per_text.select("__key", cost.alias("__c"))
    n = F.size("__c") - 2 * m

    def seg_sum(start0, length):
        # sum of costs[start0 : start0 + length] (0-based, clamped like a slice)
        return F.aggregate(F.slice("__c", (start0 + 1).cast("int"), length.cast("int")), F.lit(0).cast("bigint"), lambda a, v: a + v)

    border = lambda s, e: F.struct(s.cast("bigint").alias("start"), e.cast("bigint").alias("end"))
    init = F.struct(
        F.lit(0).cast("bigint").alias("sym"),
        F.lit(0).cast("bigint").alias("start"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("borders"),
    )

    def step(st, k):
        k = k.cast("bigint")
        close = st["sym"] + seg_sum(k, F.lit(m + 2)) > max_symbols
        borders1 = F.when(close, F.concat(st["borders"], F.array(border(st["start"], k + m)))).otherwise(st["borders"])
        start1 = F.when(close, k + 1 - m).otherwise(st["start"])
        sym1 = F.when(close, seg_sum(k + 1 - m, F.lit(m))).otherwise(st["sym"] + F.coalesce(F.try_element_at("__c", (k + 1).cast("int")), F.lit(0)))
        last = k == (n + m)
        borders2 = F.when(last, F.concat(borders1, F.array(border(start1, k + m)))).otherwise(borders1)
        return F.struct(sym1.cast("bigint").alias("sym"), start1.cast("bigint").alias("start"), borders2.alias("borders"))

    folded = x.select("__key", F.aggregate(F.sequence(F.lit(m), n + m), init, step)["borders"].alias("__b"))
    out = folded.select("__key", F.posexplode("__b").alias("block", "__x"))
    return out.select("__key", F.col("block").cast("bigint"), F.col("__x.start").alias("start"), F.col("__x.end").alias("end"))


def block_lines(blocks: DataFrame, lines: DataFrame, key: str, pos: str, line: str, margin: int = 3) -> DataFrame:
    """Materialise the lines of every block (blank for margin padding):
    ``(key, block, k, line)`` with ``k`` the padded position."""
    ex = blocks.select(key, "block", F.explode(F.sequence("start", "end")).alias("k"))
    ln = lines.select(F.col(key), (F.col(pos) - 1 + margin).alias("k"), strip(F.col(line)).alias(line))
    j = ex.join(ln, [key, "k"], "left")
    return j.withColumn(line, F.coalesce(F.col(line), F.lit("")))
