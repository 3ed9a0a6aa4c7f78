"""Deck jobs composed from the operators (TXT-03..05, 13..15, 18..21, 25, 28).

Jobs are plans over DataFrames; the caller decides when to write the result
(jobs in rounds write each round).  Index arithmetic stays in ``decimal(18,6)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import index as ix
from ..functions import text as S
from ..operators import agg as G
from ..operators import joins as J
from ..operators import window as W
from ..schema import SENTENCE_LEN_GENERATED, SENTENCE_LEN_SHORT
from ..session import cut_lineage


# JN-13 -- attach the first existing example per (block, translation)
def attach_examples(rows: DataFrame, examples: DataFrame, order: list[str], cols=("sentence",)) -> DataFrame:
    first = G.first_per_key(examples, ["block", "translation"], order).select("block", "translation", *cols)
    return rows.join(first, ["block", "translation"], "left")


# TXT-03 -- vocabulary split into lemmas / non-lemmas with carried corrections
def update_word_lists(words: DataFrame, dictionary: DataFrame, stored: DataFrame, word: str = "word") -> DataFrame:
    """``words``: (word, first_seen); ``dictionary``: (form, lemma);
    ``stored``: (word, lemma_correct) hand corrections.  Returns one row per
    word with lemma, lemma_correct (stored wins, else the lemma),
    is_lemma (three-valued) and the group order of OR-04."""
    d = G.first_per_key(dictionary, "form", ["lemma"]).select(F.col("form").alias(word), "lemma")
    x = words.join(d, word, "left").join(stored.select(word, F.col("lemma_correct").alias("__stored")), word, "left")
    x = J.fill_from(x.withColumn("lemma_correct", F.col("__stored")), "lemma_correct", "lemma").drop("__stored")
    x = x.withColumn("is_lemma", J.tri_flag(F.col("lemma"), F.col("lemma") == F.col(word)))
    grp = F.when(F.col("is_lemma"), 0).when(F.col("lemma").isNotNull(), 1).otherwise(2)
    return x.withColumn("group", grp)


# TXT-04 -- one row per article of a noun, +0.001 per extra article
def expand_articles(nouns: DataFrame, articles: DataFrame, idx: str = "idx", word: str = "word") -> DataFrame:
    """``nouns``: (idx, word); ``articles``: (lemma, articles) with
    ``;``-joined gender codes f/m/n.  Nouns without a known gender keep one
    row with a null article."""
    a = articles.select(F.col("lemma").alias("__l"), A.split_literal("articles", ";").alias("__codes"))
    j = nouns.join(a, S.base_form(nouns[word]) == a["__l"], "left")
    ex = j.select(idx, word, F.posexplode_outer("__codes").alias("__k", "__code"))
    art = A.article_of(F.col("__code"))
    return ex.select(
        ix.suffix(F.col(idx), F.coalesce(F.col("__k"), F.lit(0)), "0.001").alias(idx),
        F.when(art.isNotNull(), F.concat_ws(" ", art, S.base_form(word))).otherwise(F.col(word)).alias(word),
        art.alias("article"),
    )


# TXT-05 -- deck from lemmas: drop known words, attach existing cards, keep
# user-added rows, first per index and per word, complete rows first
def build_deck(lemmas: DataFrame, known: DataFrame, deck: DataFrame, idx: str = "idx", word: str = "word", complete_col: str = "sentence") -> DataFrame:
    new = J.anti(lemmas, known.select(word), word)
    new = new.where(~F.col(word).startswith("-"))
    existing = deck.select(word, *[c for c in deck.columns if c not in (word, idx)])
    attached = new.join(G.first_per_key(existing, word, [c for c in existing.columns if c != word]), word, "left")
    custom = deck.where(ix.is_custom_note(idx, strict_zero=True))
    out = J.union_decks(attached, custom)
    out = G.first_per_key(out, idx, [word])
    out = G.first_per_key(out, word, [idx])
    return out.withColumn("__complete", F.col(complete_col).isNull().cast("int"))


# TXT-13 -- one row per translation with existing examples re-attached;
# returns (deck, extra)
def expand_translations(deck: DataFrame, idx: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Columns: idx, word_de, part_of_speech, word_en, word_translations_en,
    sentence_de, sentence_en.  The deck is computed once, as a table that the
    parts below read."""
    deck = cut_lineage(deck, "deck")
    custom_cond = ix.is_custom_note(idx)
    custom = deck.where(custom_cond)
    rest = deck.where(~custom_cond)
    multi_cond = F.coalesce(F.col("word_translations_en").contains(","), F.lit(False))
    single = rest.where(~multi_cond)
    multi = rest.where(multi_cond).withColumn("word_en", J.normalize_verb(F.col("word_en"), F.col("part_of_speech")))
    main = multi.where(F.round(ix.frac(idx), 4) == 0)
    exploded = main.select(
        *[c for c in main.columns if c != "word_en"],
        F.posexplode(A.split_literal("word_translations_en", ",")).alias("__p", "__w"),
    ).withColumn("word_en", J.normalize_verb(S.strip("__w"), F.col("part_of_speech")))
    # n-th occurrence of a root index gets +0.001*n (positions are dense per row)
    exploded = W.suffix_occurrences(exploded.withColumn("__ord", F.col("__p")), idx, ["sentence_de", "__ord"], "0.001")
    exploded = exploded.drop("__p", "__w", "__ord")
    # existing examples per block: first row per index, then first per word
    ex = G.first_per_key(multi.withColumn("__block", ix.root(idx)), idx, ["word_en", "sentence_de"])
    ex_unique = G.first_per_key(ex.where(F.col("word_en").isNotNull()), ["__block", "word_en"], [idx]).select(
        "__block", "word_en", F.col("sentence_de").alias("__sde"), F.col("sentence_en").alias("__sen")
    )
    blocks = exploded.withColumn("__block", ix.root(idx))
    joined = blocks.join(ex_unique, ["__block", "word_en"], "left")
    all_rows = joined.withColumn("sentence_de", F.col("__sde")).withColumn("sentence_en", F.col("__sen")).drop("__sde", "__sen")
    # existing rows whose sentence is not re-used in their block go to extra
    used = all_rows.select("__block", F.col("sentence_de").alias("__used"))
    extra_rows = ex.join(used, (ex["__block"] == used["__block"]) & ex["sentence_de"].eqNullSafe(used["__used"]), "left_anti")
    extra_rows = extra_rows.join(main.select(ix.root(idx).alias("__block")), "__block", "left_semi")
    new_deck = J.union_decks(single, all_rows.drop("__block"))
    extra = J.union_decks(custom, extra_rows.drop("__block"))
    return new_deck, extra


# TXT-14 -- accepted examples become extra notes under their root note
def add_examples(deck: DataFrame, examples: DataFrame, idx: str = "idx", fields=("word", "sentence")) -> DataFrame:
    """Each example (fractional index) copies its root note and overrides
    ``fields``; examples without a root note are dropped (see DQ-05)."""
    roots = deck.where(ix.is_root(idx)).select(ix.root(idx).alias("__root"), *[F.col(c).alias(f"__d_{c}") for c in deck.columns if c != idx])
    j = examples.join(roots, ix.root(examples[idx]) == roots["__root"], "inner")
    cols = [c for c in deck.columns if c != idx]
    new_rows = j.select(idx, *[(F.col(c) if c in fields else F.col(f"__d_{c}")).alias(c) for c in cols])
    return deck.unionByName(new_rows)


# TXT-15 / TXT-18 -- length filter: failing rows keep only their key columns
def filter_by_length(deck: DataFrame, col: str, keep: list[str], bounds=SENTENCE_LEN_GENERATED) -> DataFrame:
    ok = S.length_between(col, bounds[0], bounds[1])
    out = J.blank_fields(deck, ok, keep)
    return out.withColumn("__complete", F.col(col).isNull().cast("int"))


def pick_short(deck: DataFrame, col: str, keep: list[str]) -> DataFrame:
    return filter_by_length(deck, col, keep, SENTENCE_LEN_SHORT)


# TXT-19 -- re-key the irregular base-form table to the current deck indices
def rekey_bad_baseforms(bad: DataFrame, deck: DataFrame, word: str = "word", idx: str = "idx") -> DataFrame:
    return bad.drop(idx).join(deck.select(word, idx), word, "inner").select(idx, word, "baseform")


# TXT-20 -- the full pass over a deck
def partition_deck(
    deck: DataFrame, lemmatise, lo: int, hi: int, irregular: DataFrame | None = None, idx: str = "idx", word: str = "word", sentence: str = "sentence"
) -> DataFrame:
    """``deck`` (idx, word, sentence, ...) with ``lemmas`` and ``accepted``:

    1. sentences outside ``lo .. hi`` characters are cleared;
    2. lemmas are made anew from the sentences left, by ``lemmatise``;
    3. token counts are those of these lemmas, and
    4. words of ``irregular`` (idx, word, baseform) are sought by their base
       form, both inside the rare-word filter,
    5. which accepts or rejects every sentence left;
    6. rejected rows keep their index and word alone and are merged back, one
       row per index."""
    from ..functions.text import length_between
    from ..operators.rare import filter_rare_sentences

    ok = length_between(sentence, lo, hi)
    kept = J.blank_fields(deck, ok, [idx, word]).withColumn("lemmas", lemmatise(F.col(sentence)))
    judged = filter_rare_sentences(kept, idx, word, "lemmas", irregular=irregular)
    merged = judged.unionByName(kept.where("lemmas is null").withColumn("accepted", F.lit(False)))
    merged = J.blank_fields(merged, F.col("accepted"), [idx, word, "accepted"])
    return G.first_per_key(merged, idx, [word])


# TXT-21 -- key columns deck -> raw (update + append), sentences raw -> deck
def sync_to_raw(deck: DataFrame, raw: DataFrame, keys: list[str], idx: str = "idx") -> DataFrame:
    cols = [c for c in raw.columns if c != idx]
    d = deck.select(idx, *[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__hit"))
    j = raw.join(d, idx, "full")
    return j.select(idx, *[(F.when(F.col("__hit"), F.col(f"__k_{c}")).otherwise(F.col(c)) if c in keys else F.col(c)).alias(c) for c in cols])


def sync_to_deck(deck: DataFrame, raw: DataFrame, cols: list[str], has: str, idx: str = "idx") -> DataFrame:
    r = raw.where(F.col(has).isNotNull()).select(idx, *[F.col(c).alias(f"__r_{c}") for c in cols], F.lit(True).alias("__hit"))
    j = deck.join(r, idx, "left")
    return j.select(*[(F.when(F.col("__hit"), F.col(f"__r_{c}")).otherwise(F.col(c)) if c in cols else F.col(c)).alias(c) for c in deck.columns])


# TXT-25 -- good / problematic partition
def partition_quality(df: DataFrame, sentence: str, word: str, translation: str, sentence_tr: str, bounds=SENTENCE_LEN_SHORT) -> DataFrame:
    good = S.length_between(sentence, bounds[0], bounds[1]) & F.col(sentence).contains(F.col(word)) & F.coalesce(
        F.col(sentence_tr).contains(F.col(translation)), F.lit(False)
    )
    return df.withColumn("good", F.coalesce(good, F.lit(False)))


def rework(
    deck: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    regenerate: Callable[[DataFrame, int], DataFrame],
    keep: list[str],
    idx: str = "idx",
    rounds: int | None = None,
) -> DataFrame:
    """``judge`` adds ``good`` to a deck.  Good rows are kept; problematic
    ones are cut to the columns ``keep`` (the index, the word, ..), made anew
    by ``regenerate`` and judged again, until all are good or for ``rounds``
    rounds; then both are one deck again, by index, with ``good`` false (and
    only ``keep``) for rows that are still problematic."""
    from ..streaming.incremental import retry_rounds

    judged = cut_lineage(judge(deck), "judged")
    good = F.coalesce("good", F.lit(False))
    remaining = judged.where(~good).select(*keep)

    def attempt(rows: DataFrame, r: int) -> DataFrame:
        return judge(regenerate(rows, r)).withColumn("ok", good)

    done, left = retry_rounds(remaining, attempt, rounds)
    missing = [F.lit(None).cast(t).alias(c) for c, t in deck.dtypes if c not in keep]
    still = left.select(*keep, *missing).withColumn("good", F.lit(False))
    columns = [*deck.columns, "good"]
    return judged.where(good).select(*columns).unionByName(done.select(*columns)).unionByName(still.select(*columns))


# TXT-28 -- documented cleaning recipes
def clean_deck(df: DataFrame, verb_col: str | None = None, pos_col: str | None = None, quote_cols=(), drop=()) -> DataFrame:
    out = df
    if verb_col and pos_col:
        out = out.withColumn(verb_col, F.when(F.col(pos_col) == "verb", F.lower(verb_col)).otherwise(F.col(verb_col)))
    for c in quote_cols:
        out = out.withColumn(c, F.replace(F.col(c), F.lit('"'), F.lit("")))
    return out.drop(*drop)


def order_complete_first(df: DataFrame, idx: str = "idx") -> Column:
    return [F.col("__complete"), F.col(idx)]
