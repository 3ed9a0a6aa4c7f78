"""Joins, masked updates and set operations (JN-*, UP-*, SE-*).

Join strategy is left to the planner: with AQE on, a side measured below
``spark.sql.autoBroadcastJoinThreshold`` at run time becomes a broadcast and
everything else stays a shuffle join (with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import index as ix


def _cols(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


# JN-01 / JN-02 / JN-03 -- left equi-join, overlapping names get a suffix
def left_join(a: DataFrame, b: DataFrame, keys, suffix: str = "_r") -> DataFrame:
    keys = _cols(keys)
    overlap = [c for c in b.columns if c in a.columns and c not in keys]
    b2 = b.select(*[F.col(c).alias(c + suffix) if c in overlap else F.col(c) for c in b.columns])
    return a.join(b2, keys, "left")


def lookup(df: DataFrame, col: str, dictionary: DataFrame, dict_key: str, value_cols: list[str]) -> DataFrame:
    """Left join a keyed dictionary; adaptive execution broadcasts it when
    its measured size allows."""
    return df.join(dictionary.select(F.col(dict_key).alias(col), *value_cols), col, "left")


# JN-04 -- inner lookup; duplicate dictionary keys multiply rows
def match_in_deck(words: DataFrame, deck: DataFrame, key: str) -> DataFrame:
    return words.join(deck, key, "inner")


# JN-05 / JN-06
def outer_on_index(a: DataFrame, b: DataFrame, idx: str = "idx") -> DataFrame:
    return a.join(b, idx, "full")


def left_on_index(a: DataFrame, b: DataFrame, idx: str = "idx", suffix: str = "_r") -> DataFrame:
    return left_join(a, b, idx, suffix)


# JN-07 / JN-08 / SE-04
def semi(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    return a.join(b, _cols(keys), "left_semi")


def anti(a: DataFrame, b: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    keys = _cols(keys)
    if not null_safe:
        return a.join(b, keys, "left_anti")
    bb = b.select(*[F.col(k).alias(f"__{k}") for k in keys])
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(bb[f"__{k}"])
        cond = c if cond is None else cond & c
    return a.join(bb, cond, "left_anti")


# JN-09 -- positional pairing; both sides carry an explicit position
def zip_rows(a: DataFrame, b: DataFrame, pos: str = "pos", how: str = "inner") -> DataFrame:
    """``how='inner'`` = Python zip (stops at the shorter), ``'full'`` = pandas concat."""
    return a.join(b, pos, how)


# JN-10 / JN-11 -- a note with its root note / its block [i, i+1): an
# equi-join on floor(idx) (no range join needed).
def with_root(notes: DataFrame, roots: DataFrame, idx: str = "idx", cols=None, suffix: str = "_root") -> DataFrame:
    cols = cols or [c for c in roots.columns if c != idx]
    r = roots.where(ix.is_root(idx)).select(ix.root(idx).alias("__block"), *[F.col(c).alias(c + suffix) for c in cols])
    return notes.join(r, ix.root(notes[idx]) == r["__block"], "left").drop("__block")


def join_block(a: DataFrame, b: DataFrame, idx: str = "idx", suffix: str = "_b") -> DataFrame:
    bb = b.select(ix.root(idx).alias("__block"), *[F.col(c).alias(c + suffix) for c in b.columns])
    return a.join(bb, ix.root(a[idx]) == bb["__block"], "inner").drop("__block")


# JN-12 -- membership in either of two dictionaries after normalising the key
def is_known(df: DataFrame, col: str, dicts: list[DataFrame], dict_col: str, out: str = "known") -> DataFrame:
    u = None
    for d in dicts:
        s = d.select(F.col(dict_col).alias("__w"))
        u = s if u is None else u.unionByName(s)
    u = u.distinct().withColumn(out, F.lit(True))
    j = df.join(u, df[col] == u["__w"], "left").drop("__w")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


# JN-14 -- a times table: each value times lo..hi (row count grows with df)
def times_table(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    x = df.select(F.col(col).cast("bigint").alias("a"), F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("b"))
    return x.withColumn("b", F.col("b").cast("bigint")).withColumn("c", F.col("a") * F.col("b"))


# JN-15 -- ordered pairs i < j of a list given by the caller (languages):
# pairs grow with the square of the list, so it is never derived from data.
def ordered_pairs(spark: SparkSession, values: list[str]) -> DataFrame:
    v = sorted(set(values))
    return spark.createDataFrame([(a, b) for i, a in enumerate(v) for b in v[i + 1 :]], "a string, b string")


# JN-17 -- unpivot a label matrix (row label x column label -> value)
def unpivot_matrix(df: DataFrame, row_col: str, value_cols: list[str], col_name: str = "column", value_name: str = "value") -> DataFrame:
    return df.unpivot([row_col], value_cols, col_name, value_name)


# JN-17 -- a title per language pair and label from a long label table
def deck_titles(pairs: DataFrame, labels: DataFrame, lang: str, label: str, value: str, sep: str = " - ") -> DataFrame:
    """``pairs`` (a, b); a pair has a title for each label both sides have."""
    left = labels.select(F.col(lang).alias("a"), label, F.col(value).alias("__l"))
    right = labels.select(F.col(lang).alias("b"), label, F.col(value).alias("__r"))
    j = pairs.join(left, "a").join(right, ["b", label])
    return j.select("a", "b", label, F.concat_ws(sep, "__l", "__r").alias("title"))


# JN-18 -- the texts of two languages side by side, from one row per language;
# one aggregation, rows that lack a side are dropped
def pivot_pair(df: DataFrame, keys, lang: str, text: str, a: str, b: str) -> DataFrame:
    side = lambda x: F.max(F.when(F.col(lang) == x, F.col(text)))
    both = df.where(F.col(lang).isin(a, b)).groupBy(*_cols(keys)).agg(side(a).alias("from_text"), side(b).alias("to_text"))
    return both.where("from_text is not null and to_text is not null")


# ---- masked updates (UP-*) -----------------------------------------------

# UP-01
def fill_from(df: DataFrame, target: str, source: str) -> DataFrame:
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


# UP-02 -- after a join take the right value when the `flag` column matched
def prefer_right(df: DataFrame, cols: list[str], suffix: str = "_r", flag: str | None = None) -> DataFrame:
    out = df
    for c in cols:
        r = F.col(c + suffix)
        cond = F.col((flag or c) + suffix).isNotNull()
        out = out.withColumn(c, F.when(cond, r).otherwise(F.col(c)))
    return out.drop(*[c + suffix for c in cols])


# UP-03 -- rows of `patch` replace whole rows of `base` matched on the key
# (a matched null overwrites), then every string column is stripped.
def patch_rows(base: DataFrame, patch: DataFrame, key: str = "idx", strip_strings: bool = True) -> DataFrame:
    from ..functions.text import strip

    cols = [c for c in base.columns if c != key]
    p = patch.select(F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__p_{c}") for c in cols if c in patch.columns])
    j = base.join(p, key, "left")
    sel = [F.col(key)]
    types = dict(base.dtypes)
    for c in cols:
        v = F.when(F.col("__hit"), F.col(f"__p_{c}")).otherwise(F.col(c)) if c in patch.columns else F.col(c)
        if strip_strings and types[c] == "string":
            v = strip(v)
        sel.append(v.alias(c))
    return j.select(*sel)


# UP-04 -- three-valued flag
def tri_flag(value: Column, cond: Column) -> Column:
    return F.when(value.isNull(), F.lit(None).cast("boolean")).when(cond, F.lit(True)).otherwise(F.lit(False))


# UP-05 -- verbs get 'to ' unless present; null stays null
def normalize_verb(word: Column, pos: Column) -> Column:
    need = (pos == "verb") & word.isNotNull() & ~word.startswith("to ")
    return F.when(need, F.concat(F.lit("to "), word)).otherwise(word)


# UP-06 -- compute an expensive column only where it is null
def compute_missing(df: DataFrame, target: str, fn) -> DataFrame:
    todo = df.where(F.col(target).isNull())
    done = df.where(F.col(target).isNotNull())
    return done.unionByName(todo.withColumn(target, fn(todo)))


# UP-07 -- rows failing `cond` keep only `keep` columns
def blank_fields(df: DataFrame, ok: Column, keep: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.select(
        *[F.col(c) if c in keep else F.when(ok, F.col(c)).otherwise(F.lit(None).cast(types[c])).alias(c) for c in df.columns]
    )


# UP-08 -- upsert by key: existing rows updated, new rows appended
def upsert(deck: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    cols = [c for c in deck.columns if c != key]
    inc = incoming.select(F.col(key), F.lit(True).alias("__new"), *[F.col(c).alias(f"__n_{c}") for c in cols])
    j = deck.join(inc, key, "full")
    return j.select(
        F.col(key), *[F.when(F.col("__new"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) for c in cols]
    )


# UP-09 -- replace fields by the lookup's fields, null when the lookup lacks them
def replace_from(df: DataFrame, lookup_df: DataFrame, keys, cols: list[str]) -> DataFrame:
    keys = _cols(keys)
    return df.drop(*cols).join(lookup_df.select(*keys, *cols), keys, "left")


# UP-10 -- suppress a value for listed keys
def suppress(df: DataFrame, key: str, values: list, col: str) -> DataFrame:
    return df.withColumn(col, F.when(~F.coalesce(F.col(key).isin(*values), F.lit(False)), F.col(col)))


# ---- set operations (SE-*) -----------------------------------------------

def union_decks(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# SE-08 -- all decks as one, the first row of each word under a total order
def merge_decks(decks: list[DataFrame], word: str, order: list) -> DataFrame:
    from .agg import first_per_key

    return first_per_key(union_decks(*decks), word, order)


# SE-02 -- expected ids lo..hi minus loaded ids
def not_loaded(expected: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    return expected.join(loaded, key, "left_anti")


# SE-06 -- split by condition (null counts as false) into (true, rest)
def split(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    c = F.coalesce(cond, F.lit(False))
    return df.where(c), df.where(~c)


# SE-07 -- distinct non-blank values
def distinct_non_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.trim(F.col(col)) != "").select(col).distinct()
