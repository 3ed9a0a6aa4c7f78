"""Corpus and generation jobs (TXT-01, 02, 10..12, 16, 17, 20, 22..24, 26, 27).

The neural lemmatiser of the original is not re-implemented: ``lemmatize``
takes a token table that an external tagger produced (token, dependency,
part of speech, head) plus a lemma dictionary, and does the joins; edit trees
learnt from the dictionary derive lemmas of forms that it lacks
(``operators.lemmas``).  Sentences are split by a rule
(``functions.text.split_sentences``) or with abbreviations learnt from the
texts (``operators.sentences``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays as A
from ..functions import html as H
from ..functions import text as S
from ..operators.order import seeded_hash
from ..operators import agg as G
from ..operators import joins as J
from ..operators import lemmas as LM
from ..operators import window as W
from ..schema import DROPPED_TOKENS
from ..session import cut_lineage

COMMON = 400_000  # forms that every task knows the lemmas of


# TXT-01 -- lemmatise a token table
def lemmatize(tokens: DataFrame, lemmas: DataFrame, sent: str = "sent", sep: str = ";", unseen: DataFrame | None = None) -> DataFrame:
    """``tokens``: (sent, i, token, dep, pos, head); ``lemmas``: (form, lemma).
    Lemma = dictionary lemma or the token; a separable prefix (dep 'svp' whose
    head is a VERB) is glued in front of its verb's lemma (the last such
    prefix wins); dropped tokens are removed; the sentence is rejoined in
    token order (a sentence whose tokens all drop gets an empty string).
    With ``unseen``, a model of :func:`..operators.lemmas.learn`, tokens that
    the dictionary lacks get the lemma it derives.

    The tokens are never sorted or sent one by one: those of a sentence that
    follow each other go to it as one row.  Forms the dictionary lacks are
    counted; the lemmas of the COMMON ones are known to every task, and only
    tokens of the others meet theirs by a shuffle."""
    d = G.first_per_key(lemmas, "form", ["lemma"]).select(F.col("form").alias("token"), F.col("lemma").alias("__lemma"))
    # of prefixes alone the head counts, and of other tokens the lemma
    svp = F.col("dep") == "svp"
    slim = tokens.select(sent, "i", "token", F.when(svp, F.col("head")).alias("head"), svp.alias("svp"), (F.col("pos") == "VERB").alias("verb"))
    t = slim.join(d, "token", "left")
    if unseen is not None:
        t = _with_guesses(t, unseen)
    own = t.select(sent, "i", F.coalesce("__lemma", "token").alias("lemma"), F.when(F.col("svp"), F.struct("token", "head")).alias("svp"), "verb")
    runs = _runs(own, sent).repartition(sent)
    g = runs.groupBy(sent).agg(F.collect_list(F.struct("i", "lemma", "svp", "verb")).alias("__r"))
    zipped = lambda r: F.arrays_zip(r["i"].alias("i"), r["lemma"].alias("lemma"), r["svp"].alias("svp"), r["verb"].alias("verb"))
    g = g.select(sent, F.array_sort(F.flatten(F.transform("__r", zipped))).alias("__t"))
    g = g.withColumn("__svp", F.filter("__t", lambda x: x["svp"].isNotNull()))

    def lemma(x):
        prefix = F.try_element_at(F.filter("__svp", lambda p: p["svp"]["head"] == x["i"]), F.lit(-1))["svp"]["token"]
        return F.concat(F.when(x["verb"], F.coalesce(prefix, F.lit(""))).otherwise(""), x["lemma"])

    kept = F.filter(F.transform("__t", lemma), lambda x: ~x.isin(*DROPPED_TOKENS))
    return g.select(sent, F.array_join(kept, sep).alias("lemmas"))


def _with_guesses(t: DataFrame, unseen: DataFrame) -> DataFrame:
    """``t`` with ``__lemma`` derived where it is null."""
    forms = t.where("__lemma is null and token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    guessed = LM.guess(cut_lineage(forms, "forms", "zstd"), unseen, "token").withColumn("level", F.floor(8 * F.log2("n")).cast("int"))
    guessed = cut_lineage(guessed.select("token", "level", F.col("lemma").alias("__guess")), "guesses", "zstd")
    # the lowest level at which no more than COMMON forms are as frequent
    above, lowest = 0, 0
    for level, n in sorted((tuple(r) for r in guessed.groupBy("level").count().collect()), reverse=True):  # a few hundred rows
        above += n
        if above > COMMON:
            lowest = level + 1
            break
    met = t.join(F.broadcast(guessed.where(F.col("level") >= lowest).drop("level")), "token", "left")
    met = met.withColumn("__lemma", F.coalesce("__lemma", "__guess")).drop("__guess")
    if not lowest:
        return met
    changed = guessed.where((F.col("level") < lowest) & (F.col("__guess") != F.col("token"))).drop("level")
    others = met.where("__lemma is null").join(changed, "token", "left").withColumn("__lemma", F.col("__guess")).drop("__guess")
    return met.where("__lemma is not null").unionByName(others)


def _runs(own: DataFrame, sent: str) -> DataFrame:
    """The columns of ``own`` as arrays, one row per run of rows with the
    same ``sent``."""
    others = [c for c in own.columns if c != sent]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column(sent).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
            ends = pa.array(np.append(starts, b.num_rows), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, b.column(c)) for c in others]
            yield pa.RecordBatch.from_arrays([b.column(sent).take(pa.array(starts)), *lists], names=[sent, *others])

    fields = [own.schema[sent], *(T.StructField(c, T.ArrayType(own.schema[c].dataType)) for c in others)]
    return own.mapInArrow(run, T.StructType(fields))


# TXT-02 -- keep stored lemmas by (author, title); lemmatise only new texts
def update_lemmatized(sources: DataFrame, stored: DataFrame, lemmatize_fn) -> DataFrame:
    keys = ["author", "title"]
    j = J.left_join(sources, stored.select(*keys, "lemmas"), keys)
    return J.compute_missing(j, "lemmas", lemmatize_fn)


def simple_lemmas(text: str = "text", sep: str = ";"):
    """A dictionary-free lemma string: word characters kept, lower-cased,
    split on spaces, empty tokens dropped."""

    def fn(df: DataFrame):
        toks = F.split(F.lower(S.keep_word_chars(text)), " ")
        return F.array_join(F.filter(toks, lambda x: x != ""), sep)

    return fn


# TXT-10 -- sentence cards: ids, both sentences, neighbours, titles, tokens
def sentence_cards(from_lines: DataFrame, to_lines: DataFrame, headers: DataFrame, key: str = "text_id", pos: str = "pos") -> DataFrame:
    """``from_lines`` / ``to_lines``: (text_id, pos, line); ``headers``:
    (text_id, from_title, to_title), one per text.  Python zip semantics: a
    pair exists only where both sides have the position.  One ordering of the
    pairs gives the neighbours, the sentence numbers and the titles."""
    pair = from_lines.select(key, pos, F.col("line").alias("from")).join(to_lines.select(key, pos, F.col("line").alias("to")), [key, pos])
    numbered = W.with_context(pair, key, pos, ["from", "to"], number="sentence_id", heads=headers)
    return numbered.select(
        "sentence_id", F.col(key).alias("text_id"), "from", "to", "from_prev", "to_prev", "from_next", "to_next",
        "from_title", "to_title",
        S.token_count("from").alias("from_tokens_number"), S.token_count("to").alias("to_tokens_number"),
    )


# TXT-11 -- picture cards: words paired by position, topic joined, media tag
def picture_cards(words_en: DataFrame, words_ru: DataFrame, topics: DataFrame, prefix: str = "pictures") -> DataFrame:
    """``words_*``: (id, topic_id, word); ``topics``: (topic_id, topic)."""
    w = words_en.select("id", "topic_id", F.col("word").alias("word_en")).join(words_ru.select("id", F.col("word").alias("word_ru")), "id")
    j = w.join(topics, "topic_id", "left")
    return j.select("id", "topic", "word_en", "word_ru", S.image_tag(S.media_name("topic", "word_en", prefix)).alias("image"))


# TXT-12 -- two headerless lists paired by position and named
def combine_wide(a: DataFrame, b: DataFrame, names_a: list[str], names_b: list[str], pos: str = "pos") -> DataFrame:
    aa = a.toDF(pos, *names_a)
    bb = b.toDF(pos, *names_b)
    return J.zip_rows(aa, bb, pos, "inner")


# TXT-16 -- generation batches: rows without a sentence, shuffled by a seeded
# hash, cut into blocks, one JSON request per block
def prepare_requests(deck: DataFrame, idx: str, cols: list[str], missing: str, prompt: str, model: str, size: int = 70, seed: int = 0) -> DataFrame:
    todo = deck.where(F.col(missing).isNull()).withColumn("__h", seeded_hash(idx, seed))
    blocks = W.fixed_blocks(todo, ["__h", idx], size)
    from ..sources.sinks import block_payload

    payload = block_payload(blocks.withColumn("__o", F.struct("__h", idx)), "block", "__o", [idx, *cols])
    return payload.select("block", A.to_request(F.lit(prompt), F.col("payload"), model).alias("request"))


# TXT-17 -- responses -> rows -> patched deck
def response_rows(responses: DataFrame, response_col: str, order_col: str, schema: str, sep: str = "|") -> DataFrame:
    """Parse, validate, strip fences, clean rows, keep numbered rows, split
    to columns, first per index (in ``order_col`` then line order).
    ``schema`` is a DDL string whose first field is the index and whose
    second is the word; rows with a missing or blank word are dropped."""
    content = A.response_text(F.col(response_col))
    ok = responses.withColumn("__c", content).where(F.col("__c").isNotNull())
    lines = ok.select(F.col(order_col).alias("__r"), F.posexplode(F.split(S.strip_fences(F.col("__c")), "\n")).alias("__k", "__line"))
    rows = lines.withColumn("__line", S.clean_row("__line")).where(S.starts_with_digit("__line"))
    parsed = rows.select("__r", "__k", F.from_csv("__line", schema, {"sep": sep}).alias("__p")).select("__r", "__k", "__p.*")
    index, word = parsed.columns[2:4]
    parsed = parsed.where(F.length(S.strip(word)) > 0)
    return G.first_per_key(parsed, index, ["__r", "__k"]).drop("__r", "__k")


def ingest_responses(
    deck: DataFrame, responses: DataFrame, response_col: str, order_col: str, schema: str, idx: str = "idx"
) -> tuple[DataFrame, DataFrame]:
    """(the patched deck, the responses without the required content)."""
    rows = response_rows(responses, response_col, order_col, schema)
    return J.patch_rows(deck, rows, idx), responses.where(~A.is_valid_response(response_col))


# TXT-22 -- title and first content paragraph of a page
def extract_article(pages: DataFrame, html: str = "html") -> DataFrame:
    """The text of the first h1, and of the first paragraph of the first
    article (up to the first end of a paragraph), null where they are
    missing or blank."""
    toks = pages.select("page_id", H.tokens(H.visible(html)).alias("toks"))
    article = H.first(H.elements("toks", "article"))
    parts = toks.select("page_id", H.first(H.elements("toks", "h1")).alias("h1"), F.array_join(article, "").alias("article"))
    # pages leave paragraphs open, so this one ends at the first closing tag
    para = F.regexp_extract("article", r"(?is)<p[^>]*>(.*?)</p>", 1)
    t = S.strip(H.text_of(H.inner("h1")))
    p = S.strip(H.strip_tags(F.regexp_replace(para, r"(?i)<br\s*/?>", " ")))
    return parts.select("page_id", F.nullif(t, F.lit("")).alias("title"), F.nullif(p, F.lit("")).alias("body"))


# TXT-23 -- list items with a link: href, basename, text
def extract_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """The first link of every list item that begins with one, items of
    nested lists included."""
    toks = pages.select("page_id", H.tokens(H.visible(html)).alias("toks"))
    opens = lambda item: F.get(F.filter(item, lambda t: S.strip(t) != ""), 0)  # noqa: E731  white space may precede the link
    items = F.filter(F.transform(H.elements("toks", "li", nested=True), H.inner), lambda item: F.coalesce(opens(item).rlike(r"(?is)^<a\s"), F.lit(False)))
    x = toks.select("page_id", F.posexplode(items).alias("k", "item"))
    x = x.select("page_id", (F.col("k") + 1).cast("bigint").alias("k"), H.first(H.elements("item", "a")).alias("a"))
    href = F.coalesce(H.attribute(F.get("a", 0), "href"), F.lit(""))
    return x.select("page_id", "k", href.alias("href"), S.url_basename(href).alias("basename"), S.strip(H.text_of(H.inner("a"))).alias("text"))


# TXT-24 -- container texts, inner tags -> newline, parts joined by a blank line
def extract_text(pages: DataFrame, name: str, where=None, html: str = "html") -> DataFrame:
    """The texts of all elements ``name`` whose opening tag meets ``where``;
    an element's text goes on after elements of its name inside it."""
    toks = pages.select("page_id", H.tokens(H.visible(html)).alias("toks"))
    cleaned = F.transform(H.elements("toks", name, where), lambda e: S.strip(H.text_of(H.inner(e), "\n")))
    return toks.select("page_id", F.array_join(cleaned, "\n\n").alias("text"))


# TXT-26 -- "die Sonne" -> (die, Sonne); last word of a line
def split_articles(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("article", S.split_article(col)).withColumn("noun", S.article_word(col)).withColumn("last_word", S.last_word(col))


# TXT-27 -- part -> chapter -> topic fields per word (star joins)
def with_hierarchy(words: DataFrame, topics: DataFrame, chapters: DataFrame, parts: DataFrame) -> DataFrame:
    return words.join(topics, "topic_index", "left").join(chapters, "chapter_index", "left").join(parts, "part_index", "left")
