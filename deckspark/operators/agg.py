"""Aggregations and de-duplication (AGG-*).

"First row per key" is an aggregate (``min_by`` over a total order), not a
window: Spark combines it map-side, so a hot key is reduced before the
shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import split_literal
from ..functions.index import root


def _cols(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


# AGG-01 / OR-05 / AGG-19 -- counts of exploded token lists; nulls ignored
def word_counts(df: DataFrame, col: str, sep: str = ";", out: str = "word") -> DataFrame:
    toks = df.where(F.col(col).isNotNull()).select(F.explode(split_literal(col, sep)).alias(out))
    return toks.groupBy(out).agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, word: str = "word", count: str = "count") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(word).asc())


# AGG-02 -- distinct values in first-seen order
def distinct_in_order(df: DataFrame, col: str, order: str) -> DataFrame:
    return df.groupBy(col).agg(F.min(order).alias("first_seen"))


def _struct_of(df: DataFrame, exclude=()) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


# AGG-03 / AGG-04 / AGG-05 -- first row per key under an explicit total order.
def first_per_key(df: DataFrame, key, order, last: bool = False) -> DataFrame:
    """Keep one row per ``key``: the one with the smallest ``order`` (largest
    with ``last=True``).  Null keys form one group, as in pandas."""
    keys = _cols(key)
    order = _cols(order)
    ordkey = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    row = _struct_of(df)
    pick = F.max_by(row, ordkey) if last else F.min_by(row, ordkey)
    return df.groupBy(*[F.col(k) for k in keys]).agg(pick.alias("__row")).select("__row.*")


def first_per_expr(df: DataFrame, expr: Column, order) -> DataFrame:
    """AGG-05: first row per normalised key (``expr``), nulls grouped."""
    x = df.withColumn("__key", expr)
    return first_per_key(x, "__key", order).drop("__key")


# AGG-13 -- last entry wins per key
def last_per_key(df: DataFrame, key, order) -> DataFrame:
    return first_per_key(df, key, order, last=True)


# AGG-06
def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


# AGG-07 -- per key, distinct non-null values of several columns joined by
# `sep`, in row-major first-seen order.
def collect_distinct_wide(df: DataFrame, key: str, cols: list[str], order: str, sep: str = ";") -> DataFrame:
    cells = df.select(
        key,
        F.posexplode(F.array(*[F.col(c).cast("string") for c in cols])).alias("__j", "__v"),
        F.col(order).alias("__o"),
    ).where(F.col("__v").isNotNull())
    # first position of each value: (row order, column position)
    firsts = cells.groupBy(key, "__v").agg(F.min(F.struct("__o", "__j")).alias("__pos"))
    agg = firsts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__pos", "__v"))).alias("__vals"))
    return agg.select(key, F.array_join(F.transform("__vals", lambda s: s["__v"]), sep).alias("values"))


# AGG-08
def max_value(df: DataFrame, col: str, out: str = "max_value") -> DataFrame:
    return df.agg(F.max(col).alias(out))


def block_max(df: DataFrame, idx: str = "idx") -> DataFrame:
    return df.groupBy(root(idx).alias("block")).agg(F.max(idx).alias("block_max"))


# AGG-09 / DQ-01 -- rows whose key occurs more than once; null keys are equal
def duplicates(df: DataFrame, key) -> DataFrame:
    keys = _cols(key)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    dup = dup.select(*[F.col(k).alias(f"__d_{k}") for k in keys])
    on = None
    for k in keys:
        c = df[k].eqNullSafe(dup[f"__d_{k}"])
        on = c if on is None else on & c
    return df.join(dup, on, "left_semi")


# AGG-10 -- characters of a block: sum of lengths + one per line
def block_chars(df: DataFrame, key, line: str) -> DataFrame:
    return df.groupBy(*_cols(key)).agg(F.sum(F.char_length(line) + 1).cast("bigint").alias("chars"))


# AGG-11 -- per sentence, tokens other than the target word with deck count <= n.
# Only rare words matter, so the (small) rare-word set is matched against the
# tokens -- a broadcast when the planner measures it small -- and only the
# hits are aggregated; sentences without hits get 0.
def rare_tokens(tokens: DataFrame, counts: DataFrame, sentences: DataFrame, sent_key, token: str, target: str, n: int) -> DataFrame:
    keys = _cols(sent_key)
    rare = counts.where(F.col("count") <= n).select(F.col("word").alias(token))
    hits = tokens.join(rare, token, "left_semi").where(F.col(token) != F.col(target))
    per = hits.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("rare"))
    return sentences.select(*keys).join(per, keys, "left").select(*keys, F.coalesce("rare", F.lit(0)).cast("bigint").alias("rare"))


# AGG-12 / DQ-07 -- line count per block in two tables, and the blocks that differ
def block_mismatch(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    ca = a.groupBy(key).agg(F.count(F.lit(1)).alias("n_a"))
    cb = b.groupBy(key).agg(F.count(F.lit(1)).alias("n_b"))
    j = ca.join(cb, key, "full").fillna(0, ["n_a", "n_b"])
    return j.where(F.col("n_a") != F.col("n_b"))


def rank_words(counts: DataFrame, word: str = "word", count: str = "count", out: str = "rank") -> DataFrame:
    """OR-05: 1-based rank by count descending, ties by word."""
    from .window import number_rows

    return number_rows(counts, [], [F.col(count).desc(), F.col(word)], out)


# AGG-14 -- words seen at least `min_count` times, with their rank
def too_frequent(counts: DataFrame, min_count: int, word: str = "word", count: str = "count") -> DataFrame:
    return rank_words(counts.where(F.col(count) >= min_count), word, count)


# AGG-15 -- run status counters
def run_status(results: DataFrame, status: str) -> DataFrame:
    s = F.col(status)
    return results.agg(
        F.count(F.lit(1)).alias("started"),
        F.count_if(s == "succeeded").alias("succeeded"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "rate_limited").alias("rate_limited"),
        F.count_if(~s.isin("succeeded", "failed", "rate_limited")).alias("other"),
    )


# AGG-16 -- request cost: per message 4 + tokens, + 2, + n * max_tokens
def request_cost(messages: DataFrame, key: str, tokens: str, n=None, max_tokens=None) -> DataFrame:
    from ..schema import COST_DEFAULT_MAX_TOKENS, COST_DEFAULT_N, COST_PER_MESSAGE, COST_REPLY_PRIMER

    nn = F.coalesce(F.col(n) if n else F.lit(None), F.lit(COST_DEFAULT_N))
    mt = F.coalesce(F.col(max_tokens) if max_tokens else F.lit(None), F.lit(COST_DEFAULT_MAX_TOKENS))
    per = messages.groupBy(key).agg(
        F.sum(F.col(tokens) + COST_PER_MESSAGE).alias("__msg"),
        F.max(nn * mt).alias("__completion"),
    )
    return per.select(key, (F.col("__msg") + COST_REPLY_PRIMER + F.col("__completion")).cast("bigint").alias("cost"))


# AGG-17 / DQ-12
def n_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# AGG-18 -- lines per story and the total
def story_sizes(lines: DataFrame, key: str) -> DataFrame:
    return lines.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n_sentences"))


# AGG-19 -- every word of every source with its source id (exploded, ordered)
def source_words(df: DataFrame, id_col: str, col: str, sep: str = ";") -> DataFrame:
    return df.select(id_col, F.posexplode(split_literal(col, sep)).alias("i", "word")).withColumn(
        "i", (F.col("i") + 1).cast("bigint")
    )
