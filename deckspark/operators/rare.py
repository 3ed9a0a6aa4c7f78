"""WN-11: the sequential rare-word sentence filter, by bounds on counts.

Sequential rule (rows walked from the highest index down): a row is accepted
when its word occurs among its lemmas and at least ``min_rare`` of its other
lemma occurrences have a deck count ``<= max_occ``; a rejected row lowers the
count of each of its lemma occurrences for every row visited after it.

A row's decision needs the count of a token when its turn comes: the token's
total minus its occurrences in rejected rows above.  While some of the rows
above are undecided that count has an upper bound (none of them is rejected)
and a lower bound (all are).  A row with enough tokens rare at the upper
bound is accepted, one with too few rare even at the lower bound is rejected,
whatever becomes of the others.  The highest undecided row has equal bounds,
so every round settles rows until none is left.

Only undecided rows, and of them only *live* occurrences, go to the rounds: a
token seen ``<= max_occ`` times in all is rare for every row and is counted
once; one that would stay above ``max_occ`` even if all undecided rows were
rejected is never rare.  A round is one running sum per token over sampled
ranges (no task holds a hot token) and writes one table of the rows left and
one of the rows settled.

Most occurrences are of a few *common* tokens, seen at least a
``COMMON``-th of all occurrences each and so ``COMMON`` tokens at most.  These
are known to every task and only counted where they are read; the others are
sent to their token once.  A common token is never rare if the accepted rows
hold it more than ``max_occ`` times, which some ``WITNESSES`` of these rows
prove for nearly all; occurrences of the rest join the live ones.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import split_literal
from ..functions.text import base_form
from ..schema import RARE_MAX_OCCURRENCES, RARE_MIN_COUNT_IN_SENTENCE
from ..session import cut_lineage
from .window import running_sums

ACCEPTED, REJECTED, OPEN = 1, 0, 2
COMMON = 1_000_000
WITNESSES = 200_000  # accepted rows, about


def filter_rare_sentences(
    deck: DataFrame,
    idx: str,
    word: str,
    lemmas: str,
    max_occ: int = RARE_MAX_OCCURRENCES,
    min_rare: int = RARE_MIN_COUNT_IN_SENTENCE,
    sep: str = ";",
    irregular: DataFrame | None = None,
) -> DataFrame:
    """Returns ``deck`` (rows with lemmas) plus ``accepted``.  ``idx`` must be
    a unique ``decimal(18,6)`` index.  ``irregular`` (idx, word, baseform)
    overrides the base form for rows whose index it lists."""
    rows = deck.where(F.col(lemmas).isNotNull())
    target = base_form(F.col(word))
    if irregular is not None:
        from .agg import first_per_key

        # a word listed twice for an index counts with its first base form
        irregular = first_per_key(irregular.select(idx, word, "baseform"), [idx, word], ["baseform"])
        irr = irregular.select(F.col(idx).alias("__iidx"), F.col(word).alias("__iword"), F.col("baseform").alias("__ibase"))
        rows = rows.join(irr, (rows[idx] == irr["__iidx"]) & (rows[word] == irr["__iword"]), "left")
        rows = rows.withColumn("__target", F.coalesce(F.col("__ibase"), target)).drop("__iidx", "__iword", "__ibase")
    else:
        rows = rows.withColumn("__target", target)

    rows = cut_lineage(rows, "rare-deck", "zstd")  # read several times below
    # the index as its exact unscaled long: cheap keys, same order
    rkey = (F.col(idx).cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")
    toks = rows.select(rkey.alias("r"), "__target", split_literal(lemmas, sep).alias("toks"))
    own = F.coalesce(F.size(F.filter("toks", lambda t: t == F.col("__target"))), F.lit(0))
    marks = toks.select("r", (own > 0).alias("in_sentence"), F.size("toks").alias("n"), (F.size("toks") - own).alias("others"))
    marks = cut_lineage(marks, "rare-marks", "zstd")
    n = marks.agg(F.sum("n")).first()[0] or 0
    # is_target: the occurrence is the row's own word (null when the word is null)
    each = toks.select("r", "__target", F.explode("toks").alias("t")).select("r", "t", (F.col("t") == F.col("__target")).alias("is_target"))
    common = each.groupBy("t").agg(F.count(F.lit(1)).cast("bigint").alias("total")).where(F.col("total") >= max(max_occ + 1, math.ceil(n / COMMON)))
    common = cut_lineage(common, "rare-common", "zstd")
    light = each.join(F.broadcast(common.select("t")), "t", "left_anti")
    light = cut_lineage(light.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("t"))), "rare-light", "zstd")

    other = F.coalesce(~F.col("is_target"), F.lit(True))
    rare = light.where((F.col("total") <= max_occ) & other)
    known = marks.select("r", "in_sentence", "others", F.lit(0).alias("rare")).union(rare.select("r", F.lit(False), F.lit(0), F.lit(1)))
    base = known.where("r is not null").groupBy("r").agg(
        F.max("in_sentence").alias("in_sentence"), F.sum("others").alias("others"), F.sum("rare").cast("bigint").alias("static")
    )
    enough, never = F.col("static") >= min_rare, F.col("others") < min_rare
    state = F.when(~F.col("in_sentence") | never, REJECTED).when(enough, ACCEPTED).otherwise(OPEN)
    rows_now = cut_lineage(base.select("r", "static", state.alias("state")), "rare-rows", "zstd")
    settled = [rows_now.where(F.col("state") != OPEN).select("r", "state")]

    # common tokens that accepted rows are not yet known to hold often enough
    accepted = rows_now.where(F.col("state") == ACCEPTED).select("r")
    share = max(1, accepted.count() // WITNESSES)
    witnesses = F.broadcast(accepted.where(F.pmod(F.xxhash64("r"), F.lit(share)) == 0))
    held = toks.join(witnesses, "r", "left_semi").select(F.explode("toks").alias("t")).join(F.broadcast(common.select("t")), "t", "left_semi")
    firm = held.groupBy("t").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > max_occ)
    unsure = cut_lineage(common.join(firm, "t", "left_anti"), "rare-unsure", "zstd")
    # live: occurrences of a token that could become rare, in rows that count
    # for it (rejected now or still open); gone: rejected occurrences above
    maybe = light.where(F.col("total") > max_occ).unionByName(each.join(F.broadcast(unsure), "t"))
    left = maybe.join(rows_now.where(F.col("state") != ACCEPTED), "r")
    left = left.groupBy("r", "t", "is_target", "total", "static", "state").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    left = cut_lineage(left.withColumn("gone", F.lit(0).cast("bigint")), "rare-live", "zstd")
    while not rows_now.where(F.col("state") == OPEN).isEmpty():
        # below a token's least count: what its lowest row has, less all that may go
        could = left.groupBy("t").agg((F.min(F.col("total") - F.col("gone")) - F.sum("n")).alias("least")).where(F.col("least") <= max_occ)
        live = left.join(could.select("t"), "t", "left_semi")
        # the occurrence of the row's own word is an entry of its own
        sums = running_sums(
            live, ["t"], [F.col("r").desc(), "is_target"],
            {
                "new_gone": F.when(F.col("state") == REJECTED, F.col("n")).otherwise(0),
                "open_above": F.when(F.col("state") == OPEN, F.col("n")).otherwise(0),
            },
            inclusive=False,
        )
        upper = F.col("total") - F.col("gone") - F.col("new_gone")
        sums = sums.where(F.col("state") == OPEN).withColumn("upper", upper).withColumn("lower", F.col("upper") - F.col("open_above"))
        sums = cut_lineage(sums.drop("state"), "rare-round", "zstd")
        counted = sums.where(other).groupBy("r").agg(
            F.sum(F.when(F.col("upper") <= max_occ, F.col("n")).otherwise(0)).alias("sure"),
            F.sum(F.when(F.col("lower") <= max_occ, F.col("n")).otherwise(0)).alias("hope"),
        )
        sure, hope = (F.col("static") + F.coalesce(c, F.lit(0)) for c in (F.col("sure"), F.col("hope")))
        state = F.when(sure >= min_rare, ACCEPTED).when(hope < min_rare, REJECTED).otherwise(OPEN)
        still = rows_now.where(F.col("state") == OPEN).select("r", "static")
        rows_now = cut_lineage(still.join(counted, "r", "left").select("r", "static", state.alias("state")), "rare-rows", "zstd")
        settled.append(rows_now.where(F.col("state") != OPEN).select("r", "state"))
        keep = rows_now.where(F.col("state") != ACCEPTED)
        left = sums.withColumn("gone", F.col("gone") + F.col("new_gone")).select("t", "r", "is_target", "n", "total", "gone").join(keep, "r")
    decided = settled[0]
    for s in settled[1:]:
        decided = decided.union(s)
    decided = decided.select(F.col("r").alias("__r"), "state")
    out = rows.withColumn("__r", rkey).join(decided, "__r", "left").withColumn("accepted", F.col("state") == ACCEPTED)
    return out.drop("state", "__target", "__r")
