"""Queries for the text and card jobs (TXT-*), UP-09 and DQ-09."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import index as ix
from ..functions import text as S
from ..functions.html import HTML_ENTITIES
from ..operators import cards as CD
from ..operators import joins as J
from ..operators import lemmas as LM
from ..operators import window as W
from ..schema import DROPPED_TOKENS
from . import corpus as CP
from . import deck_jobs as DJ
from .catalog import query
from .q_core import _base_form_sql, strip_sql
from .q_functions import BIGRAM_SQL
from .views import V_LINE_SQL, V_NOTE_SQL, V_TOK_SQL, rare_sql, table, v_line, v_line_idx, v_note, v_tok

D = "decimal(18,6)"
SEP_PREFIXES = ["ab", "an", "auf", "aus", "bei", "ein", "mit", "nach", "vor", "weg", "zu"]
PREFIX_SQL = "(" + ", ".join(f"'{p}'" for p in SEP_PREFIXES) + ")"
DROPPED_SQL = "(" + ", ".join(f"'{t}'" for t in DROPPED_TOKENS) + ")"


# ------------------------------------------------------------- TXT-01 -----

def _token_table(spark, sf):
    t = v_tok(spark, sf)
    return t.select(
        F.concat_ws("-", "doc_id", "pos").alias("sent"),
        "i",
        "token",
        F.when(F.lower("token").isin(*SEP_PREFIXES), "svp").otherwise("").alias("dep"),
        F.when(F.col("token").endswith("en"), "VERB").otherwise("X").alias("pos"),
        F.lit(1).cast("bigint").alias("head"),
    )


def _lemma_dict(spark, sf):
    b = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("form"))
    return b.select("form", F.lower("form").alias("lemma"))


TOKEN_TABLE_SQL = f"""(select doc_id::varchar || '-' || pos as sent, i, token,
        case when lower(token) in {PREFIX_SQL} then 'svp' else '' end as dep,
        case when ends_with(token, 'en') then 'VERB' else 'X' end as pos, cast(1 as bigint) as head from {V_TOK_SQL})"""
LEMMA_DICT_SQL = "(select form, min(lower(form)) as lemma from (select unnest(string_split(text, ' ')) as form from benchmark) group by form)"


@query(
    "txt01_lemmatize",
    f"""with t as {TOKEN_TABLE_SQL}, d as {LEMMA_DICT_SQL},
            tl as (select t.*, coalesce(d.lemma, t.token) as lemma from t left join d on t.token = d.form),
            svp as (select p.sent, p.head, arg_max(p.token, p.i) as prefix from tl p join tl h on p.sent = h.sent and p.head = h.i
                    where p.dep = 'svp' and h.pos = 'VERB' group by p.sent, p.head),
            j as (select tl.sent, tl.i, case when svp.prefix is not null then svp.prefix || tl.lemma else tl.lemma end as lemma
                  from tl left join svp on tl.sent = svp.sent and tl.i = svp.head)
       select sent, coalesce(string_agg(lemma, ';' order by i) filter (where lemma not in {DROPPED_SQL}), '') as lemmas from j group by sent""",
)
def txt01(spark, sf):
    return CP.lemmatize(_token_table(spark, sf), _lemma_dict(spark, sf))


@query("txt01_lemmatize_unseen")
def txt01u(spark, sf):
    """A dictionary of half of the forms; the others by learnt edit trees."""
    d = _lemma_dict(spark, sf)
    half = d.where(F.pmod(F.crc32("form"), F.lit(2)) == 0)
    return CP.lemmatize(_token_table(spark, sf), half, unseen=LM.learn(half))


# ------------------------------------------------------------- TXT-02 -----

@query(
    "txt02_update_lemmatized",
    f"""select d.source as author, cast(d.doc_id as varchar) as title,
              coalesce(case when l.doc_id is not null then 'stored:' || cast(d.doc_id as varchar) end,
                       array_to_string(list_filter(string_split(lower(regexp_replace(replace(d.text, chr(10), ' '), '[^\\p{{L}}\\p{{N}} -]', '', 'g')), ' '), lambda x: x <> ''), ';')) as lemmas
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def txt02(spark, sf):
    d = table(spark, sf, "documents")
    sources = d.select(F.col("source").alias("author"), F.col("doc_id").cast("string").alias("title"), "text")
    lab = table(spark, sf, "labels").select("doc_id")
    stored = d.join(lab, "doc_id", "left_semi").select(
        F.col("source").alias("author"), F.col("doc_id").cast("string").alias("title"), F.concat(F.lit("stored:"), F.col("doc_id").cast("string")).alias("lemmas")
    )
    return CP.update_lemmatized(sources, stored, CP.simple_lemmas("text")).select("author", "title", "lemmas")


# ------------------------------------------------------------- TXT-03 -----

@query(
    "txt03_update_word_lists",
    f"""with w as (select token as word, min(doc_id) as first_seen from {V_TOK_SQL} group by token),
            d as {LEMMA_DICT_SQL},
            s as (select distinct split_part(text, ' ', 1) as word, 'fixed:' || split_part(text, ' ', 1) as lemma_correct from benchmark),
            s1 as (select word, min(lemma_correct) as lemma_correct from s group by word),
            x as (select w.word, w.first_seen, d.lemma, coalesce(s1.lemma_correct, d.lemma) as lemma_correct,
                         case when d.lemma is null then null when d.lemma = w.word then true else false end as is_lemma
                  from w left join d on w.word = d.form left join s1 on w.word = s1.word)
       select word, first_seen, lemma, lemma_correct, is_lemma,
              case when is_lemma then 0 when lemma is not null then 1 else 2 end as "group" from x""",
)
def txt03(spark, sf):
    t = v_tok(spark, sf)
    words = t.groupBy(F.col("token").alias("word")).agg(F.min("doc_id").alias("first_seen"))
    b = table(spark, sf, "benchmark")
    first = F.split_part("text", F.lit(" "), F.lit(1))
    stored = b.select(first.alias("word"), F.concat(F.lit("fixed:"), first).alias("lemma_correct")).groupBy("word").agg(F.min("lemma_correct").alias("lemma_correct"))
    return DJ.update_word_lists(words, _lemma_dict(spark, sf), stored)


# ------------------------------------------------------------- TXT-04 -----

NOUNS_SQL = f"""(select token as word, row_number() over (order by token) as n from (select distinct token from {V_TOK_SQL}
                 where regexp_matches(token, '^\\p{{Lu}}\\p{{Ll}}+$')))"""
ARTICLES_RULE_SQL = "case when ends_with(word, 'ung') then 'f;m' when ends_with(word, 'e') then 'f' when ends_with(word, 'er') then 'm;n' else 'n' end"


def _nouns(spark, sf):
    t = v_tok(spark, sf).where(F.col("token").rlike(r"^\p{Lu}\p{Ll}+$")).select(F.col("token").alias("word")).distinct()
    return W.number_rows(t, [], ["word"], "n")


def _articles_of(col):
    c = F.col(col)
    return F.when(c.endswith("ung"), "f;m").when(c.endswith("e"), "f").when(c.endswith("er"), "m;n").otherwise("n")


@query(
    "txt04_expand_articles",
    f"""select cast(cast(n as {D}) + cast(k - 1 as {D}) * cast(0.001 as {D}) as {D}) as idx,
              case code when 'f' then 'die' when 'm' then 'der' when 'n' then 'das' end || ' ' || word as word,
              case code when 'f' then 'die' when 'm' then 'der' when 'n' then 'das' end as article
       from (select n, word, {ARTICLES_RULE_SQL} as arts from {NOUNS_SQL}),
       lateral (select unnest(string_split(arts, ';')) as code, generate_subscripts(string_split(arts, ';'), 1) as k)""",
)
def txt04(spark, sf):
    n = _nouns(spark, sf)
    nouns = n.select(F.col("n").cast(D).alias("idx"), "word")
    arts = n.select(F.col("word").alias("lemma"), _articles_of("word").alias("articles"))
    return DJ.expand_articles(nouns, arts)


# ------------------------------------------------------------- TXT-05 -----

@query(
    "txt05_build_deck",
    f"""with lem as (select token as word, cast(min(doc_id) as {D}) as idx from {V_TOK_SQL} group by token),
            known as (select distinct unnest(string_split(text, ' ')) as word from benchmark),
            said as (select conv_id, turn, unnest(string_split(text, ' ')) as word from conversations),
            deck as (select word, min(cast(conv_id as varchar) || '-' || cast(turn as varchar)) as sentence_key from said group by word),
            new as (select * from lem where word not in (select word from known where word is not null) and not starts_with(word, '-')),
            attached as (select new.word, new.idx, cast(deck.sentence_key as varchar) as sentence from new left join deck on new.word = deck.word),
            custom as (select word || '*' as word, cast(idx + 0.0001 as {D}) as idx, null as sentence from lem where length(word) > 12),
            u as (select * from attached union all select * from custom),
            f1 as (select * from (select *, row_number() over (partition by idx order by word) as rn from u) where rn = 1),
            f2 as (select * from (select *, row_number() over (partition by word order by idx) as rn2 from f1) where rn2 = 1)
       select word, idx, sentence, cast(sentence is null as integer) as __complete from f2""",
)
def txt05(spark, sf):
    """Words of all documents; sentences come from the conversations."""
    lemmas = v_tok(spark, sf).groupBy(F.col("token").alias("word")).agg(F.min("doc_id").cast(D).alias("idx"))
    known = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    said = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("said"), F.explode(F.split("text", " ")).alias("word"))
    existing = said.groupBy("word").agg(F.min("said").alias("sentence"))
    custom = lemmas.where(F.char_length("word") > 12).select(
        F.concat("word", F.lit("*")).alias("word"), ix.suffix(F.col("idx"), F.lit(1), "0.0001").alias("idx"), F.lit(None).cast("string").alias("sentence")
    )
    deck = J.union_decks(existing.withColumn("idx", F.lit(None).cast(D)), custom)
    return DJ.build_deck(lemmas, known, deck).select("word", "idx", "sentence", "__complete")


# ------------------------------------------------------------- TXT-06 -----

@query(
    "txt06_render_template",
    """select c_custkey, replace(replace(replace('{{name}} ({{segment}}) has {{balance}}', '{{name}}', c_name), '{{segment}}', c_mktsegment),
                                 '{{balance}}', cast(cast(c_acctbal as decimal(18,2)) as varchar)) as rendered from customer""",
)
def txt06(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    r = CD.render_template(c, "{{name}} ({{segment}}) has {{balance}}", ["name", "segment", "balance"], "rendered", strict=True)
    return r.select("c_custkey", "rendered")


# ------------------------------------------------------------- TXT-07 -----

CARD_TEMPLATES = [
    ("en-de", "<div>{{word_en}}</div>{{#hint}}<i>{{hint}}</i>{{/hint}}", "{{FrontSide}}<hr id=answer>{{word_de}} {{tts de_DE:word_de}}"),
    ("de-en", "<div>{{word_de}}</div>", "{{FrontSide}}<hr id=answer>{{word_en}}"),
]


@query(
    "txt07_render_cards",
    """with n as (select p_partkey, p_name as word_en, p_brand as word_de, case when p_size > 25 then p_type else '' end as hint from part)
       select p_partkey, 'en-de' as template,
              '<div>' || word_en || '</div>' || case when hint <> '' then '<i>' || hint || '</i>' else '' end as front,
              '<div>' || word_en || '</div>' || case when hint <> '' then '<i>' || hint || '</i>' else '' end || '<hr id=answer>' || word_de || ' {{tts de_DE:word_de}}' as back
       from n
       union all
       select p_partkey, 'de-en', '<div>' || word_de || '</div>', '<div>' || word_de || '</div><hr id=answer>' || word_en from n""",
)
def txt07(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("word_en"), F.col("p_brand").alias("word_de"), F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("").alias("hint")
    )
    cards = CD.render_cards(p, CARD_TEMPLATES, ["word_en", "word_de", "hint"])
    return cards.select("p_partkey", "template", "front", "back")


# ---------------------------------------------------------- TXT-08/09 -----

def _cloze_notes(spark, sf):
    li = table(spark, sf, "lineitem")
    a = F.col("l_linenumber").cast("bigint")
    b = F.col("l_quantity").cast("bigint")
    return li.select("l_orderkey", "l_linenumber", CD.cloze_note(a, b, a * b).alias("text"))


CLOZE_SQL = """(select l_orderkey, l_linenumber, cast(l_linenumber as varchar) as a, cast(cast(l_quantity as bigint) as varchar) as b,
                       cast(l_linenumber * cast(l_quantity as bigint) as varchar) as c from lineitem)"""


@query(
    "txt08_expand_cloze",
    f"""select l_orderkey, l_linenumber, cloze,
              case cloze when 1 then '[...] × ' || b || ' = ' || c when 2 then a || ' × [...] = ' || c else a || ' × ' || b || ' = [...]' end as front,
              a || ' × ' || b || ' = ' || c as back
       from {CLOZE_SQL}, (values (1), (2), (3)) v(cloze)""",
)
def txt08(spark, sf):
    cards = CD.expand_cloze(_cloze_notes(spark, sf), "text")
    return cards.select("l_orderkey", "l_linenumber", "cloze", "front", "back")


@query(
    "txt09_cloze_answer",
    f"select l_orderkey, l_linenumber, cloze, case cloze when 1 then a when 2 then b else c end as answer from {CLOZE_SQL}, (values (1), (2), (3)) v(cloze)",
)
def txt09(spark, sf):
    cards = CD.expand_cloze(_cloze_notes(spark, sf), "text")
    return cards.select("l_orderkey", "l_linenumber", "cloze", CD.cloze_answer("text", "cloze").alias("answer"))


# ---------------------------------------------------------- TXT-10 / SNK-11 ----

def _sentence_cards(spark, sf):
    l = v_line(spark, sf)
    from_lines = l.select(F.col("doc_id").alias("text_id"), "pos", F.col("sentence").alias("line"))
    to_lines = l.select(F.col("doc_id").alias("text_id"), "pos", F.lower("sentence").alias("line"))
    heads = table(spark, sf, "documents").select(
        F.col("doc_id").alias("text_id"), F.concat(F.lit("Text "), F.col("doc_id").cast("string")).alias("from_title"), F.concat(F.lit("text "), F.col("source")).alias("to_title")
    )
    return CP.sentence_cards(from_lines, to_lines, heads)


CARDS_SQL = f"""(select row_number() over (order by l.doc_id, l.pos) as sentence_id, l.doc_id as text_id,
          l.sentence as "from", lower(l.sentence) as "to",
          coalesce(lag(l.sentence) over w, '') as from_prev, coalesce(lower(lag(l.sentence) over w), '') as to_prev,
          coalesce(lead(l.sentence) over w, '') as from_next, coalesce(lower(lead(l.sentence) over w), '') as to_next,
          'Text ' || cast(l.doc_id as varchar) as from_title, 'text ' || d.source as to_title,
          cast(len(string_split(l.sentence, ' ')) as bigint) as from_tokens_number,
          cast(len(string_split(lower(l.sentence), ' ')) as bigint) as to_tokens_number
       from {V_LINE_SQL} l join documents d on l.doc_id = d.doc_id window w as (partition by l.doc_id order by l.pos))"""


@query("txt10_sentence_cards", f"select * from {CARDS_SQL}")
def txt10(spark, sf):
    return _sentence_cards(spark, sf)


def _pad_sql(x: str, w: int) -> str:
    return f"(case when length(cast({x} as varchar)) >= {w} then cast({x} as varchar) else lpad(cast({x} as varchar), {w}, '0') end)"


@query(
    "snk11_write_sentence_deck",
    f"""select sentence_id, replace({_pad_sql('sentence_id', 5)} || '|' || {_pad_sql('text_id', 4)} || '|' || "from" || '|' || "to" || '|' || from_prev || '|' || to_prev
              || '|' || from_next || '|' || to_next || '|' || from_title || '|' || to_title || '|' || {_pad_sql('from_tokens_number', 2)} || '|' || {_pad_sql('to_tokens_number', 2)},
              '"', '""') as value from {CARDS_SQL}""",
)
def snk11(spark, sf):
    from ..session import scratch_path
    from ..sources import readers as R
    from ..sources import sinks as K

    path = scratch_path(spark, "sdeck")
    K.write_sentence_deck(_sentence_cards(spark, sf), path, codec="gzip")
    back = R.read_lines(spark, path, line_col="value")
    return back.select(F.col("line_no").alias("sentence_id"), "value")


# ------------------------------------------------------------- TXT-11 -----

@query(
    "txt11_picture_cards",
    """select p_partkey as id, p_type as topic, p_name as word_en, upper(p_name) as word_ru,
              '<img src="pictures___' || replace(lower(p_type), ' ', '-') || '___' || replace(lower(p_name), ' ', '-') || '.jpg">' as image
       from part""",
)
def txt11(spark, sf):
    p = table(spark, sf, "part")
    topics = p.select("p_type").distinct()
    topics = W.number_rows(topics, [], ["p_type"], "topic_id").select("topic_id", F.col("p_type").alias("topic"))
    pt = p.join(topics.withColumnRenamed("topic", "p_type"), "p_type")
    en = pt.select(F.col("p_partkey").alias("id"), "topic_id", F.col("p_name").alias("word"))
    ru = pt.select(F.col("p_partkey").alias("id"), "topic_id", F.upper("p_name").alias("word"))
    return CP.picture_cards(en, ru, topics)


# ------------------------------------------------------------- TXT-12 -----

@query(
    "txt12_combine_wide",
    """select a.pos, a.word_combination_de, b.word_combination_en from
       (select row_number() over (order by p_partkey) as pos, p_name as word_combination_de from part) a
       join (select row_number() over (order by s_suppkey) as pos, s_name as word_combination_en from supplier) b on a.pos = b.pos""",
)
def txt12(spark, sf):
    a = W.number_rows(table(spark, sf, "part"), [], ["p_partkey"], "pos").select("pos", "p_name")
    b = W.number_rows(table(spark, sf, "supplier"), [], ["s_suppkey"], "pos").select("pos", "s_name")
    return CP.combine_wide(a, b, ["word_combination_de"], ["word_combination_en"])


# ------------------------------------------------------------- TXT-13 -----

def _freq_deck(spark, sf):
    """A frequency deck from part: roots with comma-joined translations, one
    alternative-meaning row per root (+0.001), user rows (+0.0001) for big parts."""
    p = table(spark, sf, "part")
    root = p.select(
        F.col("p_partkey").cast(D).alias("idx"),
        F.col("p_brand").alias("word_de"),
        F.when(F.col("p_type") == "PROMO", "verb").otherwise("noun").alias("part_of_speech"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word_en"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("word_translations_en"),
        F.concat(F.lit("s-"), F.col("p_partkey").cast("string")).alias("sentence_de"),
        F.lit(None).cast("string").alias("sentence_en"),
    )
    alt = p.select(
        ix.suffix(F.col("p_partkey").cast(D), F.lit(1), "0.001").alias("idx"),
        F.col("p_brand").alias("word_de"),
        F.when(F.col("p_type") == "PROMO", "verb").otherwise("noun").alias("part_of_speech"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word_en"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("word_translations_en"),
        F.concat(F.lit("alt-"), F.col("p_partkey").cast("string")).alias("sentence_de"),
        F.col("p_type").alias("sentence_en"),
    )
    custom = p.where(F.col("p_size") > 45).select(
        ix.suffix(F.col("p_partkey").cast(D), F.lit(1), "0.0001").alias("idx"),
        F.col("p_brand").alias("word_de"),
        F.lit("noun").alias("part_of_speech"),
        F.col("p_name").alias("word_en"),
        F.lit(None).cast("string").alias("word_translations_en"),
        F.lit("user").alias("sentence_de"),
        F.lit(None).cast("string").alias("sentence_en"),
    )
    return root.unionByName(alt).unionByName(custom)


FREQ_DECK_SQL = f"""(
  select cast(p_partkey as {D}) as idx, p_brand as word_de, case when p_type = 'PROMO' then 'verb' else 'noun' end as part_of_speech,
         split_part(p_name, ' ', 1) as word_en, replace(p_name, ' ', ', ') as word_translations_en,
         's-' || cast(p_partkey as varchar) as sentence_de, cast(null as varchar) as sentence_en from part
  union all
  select cast(p_partkey + 0.001 as {D}), p_brand, case when p_type = 'PROMO' then 'verb' else 'noun' end,
         split_part(p_name, ' ', 2), replace(p_name, ' ', ', '), 'alt-' || cast(p_partkey as varchar), p_type from part
  union all
  select cast(p_partkey + 0.0001 as {D}), p_brand, 'noun', p_name, null, 'user', null from part where p_size > 45)"""

NV = "(case when part_of_speech = 'verb' and {w} is not null and not starts_with({w}, 'to ') then 'to ' || {w} else {w} end)"

TXT13_CTE = f"""with deck as {FREQ_DECK_SQL},
  rest as (select * from deck where not (round(idx - floor(idx), 4) >= 0.0001 and round(idx - floor(idx), 4) < 0.001)),
  multi as (select idx, word_de, part_of_speech, {NV.format(w='word_en')} as word_en, word_translations_en, sentence_de, sentence_en
            from rest where coalesce(contains(word_translations_en, ','), false)),
  single as (select * from rest where not coalesce(contains(word_translations_en, ','), false)),
  main as (select * from multi where round(idx - floor(idx), 4) = 0),
  exploded as (select m.idx, m.word_de, m.part_of_speech, m.word_translations_en, m.sentence_de, u.k,
                      {NV.format(w=strip_sql('u.w'))} as word_en
               from main m, lateral (select unnest(string_split(m.word_translations_en, ',')) as w,
                                            generate_subscripts(string_split(m.word_translations_en, ','), 1) as k) u),
  numbered as (select *, cast(idx + cast(row_number() over (partition by idx order by sentence_de, k) - 1 as {D}) * cast(0.001 as {D}) as {D}) as new_idx from exploded),
  ex as (select * from (select *, cast(floor(idx) as bigint) as block, row_number() over (partition by idx order by word_en, sentence_de) as rn from multi) where rn = 1),
  ex_u as (select * from (select *, row_number() over (partition by block, word_en order by idx) as rn2 from ex where word_en is not null) where rn2 = 1),
  all_rows as (select n.new_idx as idx, n.word_de, n.part_of_speech, n.word_en, n.word_translations_en, e.sentence_de, e.sentence_en, cast(floor(n.new_idx) as bigint) as block
               from numbered n left join ex_u e on cast(floor(n.new_idx) as bigint) = e.block and n.word_en = e.word_en),
  extra_rows as (select ex.idx, ex.word_de, ex.part_of_speech, ex.word_en, ex.word_translations_en, ex.sentence_de, ex.sentence_en from ex
                 where ex.block in (select cast(floor(idx) as bigint) from main)
                   and not exists (select 1 from all_rows a where a.block = ex.block and a.sentence_de is not distinct from ex.sentence_de))"""


@query(
    "txt13_expand_translations",
    TXT13_CTE + """
  select idx, word_de, part_of_speech, word_en, word_translations_en, sentence_de, sentence_en from single
  union all select idx, word_de, part_of_speech, word_en, word_translations_en, sentence_de, sentence_en from all_rows""",
)
def txt13(spark, sf):
    new_deck, _extra = DJ.expand_translations(_freq_deck(spark, sf))
    return new_deck


@query(
    "txt13_extra_rows",
    TXT13_CTE + """
  select idx, word_de, part_of_speech, word_en, word_translations_en, sentence_de, sentence_en from deck
         where round(idx - floor(idx), 4) >= 0.0001 and round(idx - floor(idx), 4) < 0.001
  union all select * from extra_rows""",
)
def txt13x(spark, sf):
    _deck, extra = DJ.expand_translations(_freq_deck(spark, sf))
    return extra


# ------------------------------------------------------------- TXT-14 -----

@query(
    "txt14_add_examples",
    f"""with n as {V_NOTE_SQL},
            ex as (select cast(cast(l_orderkey as {D}) + cast(l_linenumber as {D}) * cast(0.0001 as {D}) as {D}) as idx, l_returnflag as word
                   from lineitem where l_returnflag = 'N'),
            roots as (select * from n where idx = floor(idx))
       select idx, word, translation, rank from n
       union all select ex.idx, ex.word, r.translation, r.rank from ex join roots r on floor(ex.idx) = r.idx""",
)
def txt14(spark, sf):
    n = v_note(spark, sf)
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "N")
    ex = li.select(ix.suffix(F.col("l_orderkey").cast(D), F.col("l_linenumber"), "0.0001").alias("idx"), F.col("l_returnflag").alias("word"))
    return DJ.add_examples(n, ex, "idx", ("word",))


# ------------------------------------------------------------- TXT-15 / 18 --

@query(
    "txt15_pick_short",
    f"""select doc_id, pos, case when length(sentence) between 30 and 45 then sentence end as sentence,
              cast(not coalesce(length(sentence) between 30 and 45, false) as integer) as __complete from {V_LINE_SQL}""",
)
def txt15(spark, sf):
    return DJ.pick_short(v_line(spark, sf), "sentence", ["doc_id", "pos"])


@query(
    "txt18_filter_by_length",
    f"""select doc_id, pos, case when length(sentence) between 60 and 70 then sentence end as sentence,
              cast(not coalesce(length(sentence) between 60 and 70, false) as integer) as __complete from {V_LINE_SQL}""",
)
def txt18(spark, sf):
    return DJ.filter_by_length(v_line(spark, sf), "sentence", ["doc_id", "pos"])


# ------------------------------------------------------------- TXT-19 -----

@query(
    "txt19_rekey_bad_baseforms",
    """with bad as (select distinct p_name as word, split_part(p_name, ' ', 2) as baseform from part where p_size > 40),
            deck as (select p_partkey as idx, p_name as word from part)
       select deck.idx, bad.word, bad.baseform from bad join deck on bad.word = deck.word""",
)
def txt19(spark, sf):
    p = table(spark, sf, "part")
    bad = p.where(F.col("p_size") > 40).select(F.col("p_name").alias("word"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("baseform")).distinct()
    deck = p.select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("word"))
    return DJ.rekey_bad_baseforms(bad, deck)


# ------------------------------------------------------------- TXT-20 -----

@query(
    "txt20_partition_deck",
    rare_sql(
        f"""select r, cast(r as {D}) as idx, word, sentence, replace(sentence, ' ', ';') as lemmas,
                   case when ends_with(word, '.') then regexp_replace(word, '\\.$', '') else {_base_form_sql('word')} end as target
            from (select row_number() over (order by doc_id, pos) as r, split_part(sentence, ' ', 1) as word,
                         case when length(sentence) between 30 and 200 then sentence end as sentence from {V_LINE_SQL})""",
        """select idx, word, case when accepted then sentence end as sentence, case when accepted then lemmas end as lemmas, coalesce(accepted, false) as accepted
           from deck left join decided using (r)""",
    ),
)
def txt20(spark, sf):
    deck = v_line_idx(spark, sf).select("idx", F.split_part("sentence", F.lit(" "), F.lit(1)).alias("word"), "sentence")
    irregular = deck.where(F.col("word").endswith(".")).select("idx", "word", F.regexp_replace("word", r"\.$", "").alias("baseform"))
    return DJ.partition_deck(deck, lambda s: F.array_join(F.split(s, " "), ";"), 30, 200, irregular)


# ------------------------------------------------------------- TXT-21 -----

@query(
    "txt21_sync_to_raw",
    """with deck as (select o_orderkey as idx, o_orderstatus as word, o_orderpriority as pos from orders),
            raw as (select o_orderkey as idx, lower(o_orderstatus) as word, null as pos, 'sent ' || cast(o_orderkey as varchar) as sentence
                    from orders where o_orderdate >= timestamp '1998-01-01')
       select coalesce(r.idx, d.idx) as idx, case when d.idx is not null then d.word else r.word end as word,
              case when d.idx is not null then d.pos else r.pos end as pos, r.sentence
       from raw r full join deck d on r.idx = d.idx""",
)
def txt21(spark, sf):
    o = table(spark, sf, "orders")
    deck = o.select(F.col("o_orderkey").alias("idx"), F.col("o_orderstatus").alias("word"), F.col("o_orderpriority").alias("pos"))
    raw = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).select(
        F.col("o_orderkey").alias("idx"), F.lower("o_orderstatus").alias("word"), F.lit(None).cast("string").alias("pos"),
        F.concat(F.lit("sent "), F.col("o_orderkey").cast("string")).alias("sentence"),
    )
    return DJ.sync_to_raw(deck, raw, ["word", "pos"])


@query(
    "txt21_sync_to_deck",
    """with deck as (select o_orderkey as idx, o_orderstatus as word, cast(null as varchar) as sentence from orders),
            raw as (select o_orderkey as idx, case when o_orderstatus = 'F' then 'sent ' || cast(o_orderkey as varchar) end as sentence
                    from orders where o_orderdate >= timestamp '1998-01-01')
       select d.idx, d.word, case when r.sentence is not null then r.sentence else d.sentence end as sentence
       from deck d left join raw r on d.idx = r.idx""",
)
def txt21b(spark, sf):
    o = table(spark, sf, "orders")
    deck = o.select(F.col("o_orderkey").alias("idx"), F.col("o_orderstatus").alias("word"), F.lit(None).cast("string").alias("sentence"))
    raw = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).select(
        F.col("o_orderkey").alias("idx"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("sent "), F.col("o_orderkey").cast("string"))).alias("sentence")
    )
    return DJ.sync_to_deck(deck, raw, ["sentence"], "sentence")


# ------------------------------------------------------------ TXT-22..24 --

CLEAN_HTML_SQL = "regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g')"


def _strip_tags_sql(x: str, repl: str = "''") -> str:
    out = f"regexp_replace({x}, '<[^>]*>', {repl}, 'g')"
    for ent, ch in HTML_ENTITIES:
        esc = ch.replace("'", "''")
        out = f"replace({out}, '{ent}', '{esc}')"
    return out


@query(
    "txt22_extract_article",
    f"""select page_id,
              nullif({strip_sql(_strip_tags_sql(f"regexp_extract({CLEAN_HTML_SQL}, '(?is)<h1[^>]*>(.*?)</h1>', 1)"))}, '') as title,
              nullif({strip_sql(_strip_tags_sql(f"regexp_replace(regexp_extract({CLEAN_HTML_SQL}, '(?is)<article[^>]*>.*?<p[^>]*>(.*?)</p>', 1), '(?i)<br\\s*/?>', ' ', 'g')"))}, '') as body
       from pages""",
)
def txt22(spark, sf):
    return CP.extract_article(table(spark, sf, "pages"))


@query(
    "dq09_check_pages",
    f"""select page_id from (select page_id,
              nullif({strip_sql(_strip_tags_sql(f"regexp_extract({CLEAN_HTML_SQL}, '(?is)<h1[^>]*>(.*?)</h1>', 1)"))}, '') as title,
              nullif({strip_sql(_strip_tags_sql(f"regexp_replace(regexp_extract({CLEAN_HTML_SQL}, '(?is)<article[^>]*>.*?<p[^>]*>(.*?)</p>', 1), '(?i)<br\\s*/?>', ' ', 'g')"))}, '') as body
       from pages) where title is null or body is null or not regexp_matches(body, '\\p{{L}}{{3,}}')""",
)
def dq09(spark, sf):
    from ..operators.checks import check_pages

    a = CP.extract_article(table(spark, sf, "pages"))
    bad = check_pages(a, ["title", "body"]).select("page_id")
    wordless = a.where(F.col("body").isNotNull() & F.col("title").isNotNull() & ~F.col("body").rlike(r"\p{L}{3,}")).select("page_id")
    return bad.unionByName(wordless)


@query(
    "txt23_extract_items",
    f"""select page_id, cast(k as bigint) as k, regexp_extract(item, 'href="([^"]*)"', 1) as href,
              string_split(regexp_extract(item, 'href="([^"]*)"', 1), '/')[-1] as basename,
              {strip_sql(_strip_tags_sql("regexp_extract(item, '(?s)<a [^>]*>(.*?)</a>', 1)"))} as text
       from (select page_id, unnest(a) as item, generate_subscripts(a, 1) as k from (
             select page_id, regexp_extract_all({CLEAN_HTML_SQL}, '(<li[^>]*>\\s*<a [^>]*>.*?</a>)', 1) as a from pages))""",
)
def txt23(spark, sf):
    return CP.extract_items(table(spark, sf, "pages"))


@query(
    "txt24_extract_text",
    f"""select page_id, array_to_string(list_transform(regexp_extract_all({CLEAN_HTML_SQL}, '(?s)<footer>(.*?)</footer>', 1),
              lambda p: {strip_sql(_strip_tags_sql('p', "chr(10)"))}), chr(10) || chr(10)) as text from pages""",
)
def txt24(spark, sf):
    return CP.extract_text(table(spark, sf, "pages"), "footer")


@query(
    "txt24_nested_containers",
    f"""select page_id, {strip_sql(_strip_tags_sql("regexp_replace(" + CLEAN_HTML_SQL.replace("html", "'<div>' || html || '</div>'") + ", '^<div>|</div>$', '', 'g')", "chr(10)"))} as text,
              array_to_string(list_transform(regexp_extract_all(regexp_extract({CLEAN_HTML_SQL}, '(?s)<nav>.*?<ul>(.*?)</ul>.*?</nav>', 1), '(?s)<li>(.*?)</li>', 1),
                lambda x: {_strip_tags_sql('x')}), '|') as links
       from pages""",
)
def txt24n(spark, sf):
    """The text of a container that holds others of its name, and a chain of
    searches: the items of the list in the navigation."""
    pages = table(spark, sf, "pages").withColumn("html", F.concat(F.lit("<div>"), "html", F.lit("</div>")))
    whole = CP.extract_text(pages, "div")
    toks = pages.select("page_id", H.tokens(H.visible("html")).alias("toks"))
    items = H.elements(H.first(H.elements(H.first(H.elements("toks", "nav")), "ul")), "li")
    links = toks.select("page_id", F.array_join(F.transform(items, lambda e: H.text_of(H.inner(e))), "|").alias("links"))
    return whole.join(links, "page_id")


# ------------------------------------------------------------- TXT-25 -----

@query(
    "txt25_partition_quality",
    f"""select l.doc_id, l.pos, coalesce(length(l.sentence) between 30 and 45 and contains(l.sentence, split_part(l.sentence, ' ', 2))
                                      and coalesce(contains(lower(l.sentence), lower(split_part(l.sentence, ' ', 2))), false), false) as good
       from {V_LINE_SQL} l""",
)
def txt25(spark, sf):
    l = v_line(spark, sf).withColumn("word", F.split_part("sentence", F.lit(" "), F.lit(2)))
    l = l.withColumn("sentence_tr", F.lower("sentence")).withColumn("word_tr", F.lower("word"))
    return DJ.partition_quality(l, "sentence", "word", "word_tr", "sentence_tr").select("doc_id", "pos", "good")


@query(
    "txt25_rework",
    f"""with l as (select doc_id, pos, sentence, split_part(sentence, ' ', 2) as word from {V_LINE_SQL}),
            g as (select *, length(sentence) between 30 and 45 and contains(sentence, word) as good, 2 * length(word) + 21 as n from l),
            r as (select *, case when n + 0 between 30 and 45 then 0 when n + 8 between 30 and 45 then 1 when n + 16 between 30 and 45 then 2 end as round from g)
       select doc_id, pos, word, good or round is not null as good,
              case when good then sentence when round is not null then word || ' ' || repeat('x', (20 + 8 * round + length(word))::int) end as sentence from r""",
)
def txt25r(spark, sf):
    """Lines that are not good are cut to their key and word, made anew and
    judged again, three times; the rest stays without a sentence."""
    deck = v_line(spark, sf).withColumn("word", F.split_part("sentence", F.lit(" "), F.lit(2)))

    def judge(rows):
        return DJ.partition_quality(rows, "sentence", "word", "word", "sentence")

    def regenerate(rows, r):
        filler = F.repeat(F.lit("x"), F.char_length("word") + (20 + 8 * r))
        return rows.withColumn("sentence", F.concat("word", F.lit(" "), filler))

    return DJ.rework(deck, judge, regenerate, ["doc_id", "pos", "word"], rounds=3).select("doc_id", "pos", "word", "sentence", "good")


# ------------------------------------------------------------- TXT-26 -----

@query(
    "txt26_split_article",
    f"""select doc_id, pos, k, phrase,
              nullif(regexp_extract(phrase, '^(der|die|das) (.+)$', 1), '') as article,
              case when regexp_extract(phrase, '^(der|die|das) (.+)$', 2) = '' then phrase else regexp_extract(phrase, '^(der|die|das) (.+)$', 2) end as noun,
              string_split({strip_sql('phrase')}, ' ')[-1] as last_word
       from (select doc_id, pos, k, lower(split_part(phrase, ' ', 1)) || substr(phrase, length(split_part(phrase, ' ', 1)) + 1) as phrase from {BIGRAM_SQL})""",
)
def txt26(spark, sf):
    from .q_functions import _bigrams

    b = _bigrams(spark, sf)
    first = F.substring_index("phrase", " ", 1)
    low = F.concat(F.lower(first), F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 1)"))
    return CP.split_articles(b.select("doc_id", "pos", "k", low.alias("phrase")), "phrase")


# ------------------------------------------------------------- TXT-27 -----

@query(
    "txt27_with_hierarchy",
    """select c.c_custkey as word_index, c.c_name as word, n.n_nationkey as topic_index, n.n_name as topic,
              r.r_regionkey as chapter_index, r.r_name as chapter, r.r_regionkey // 3 as part_index,
              case when r.r_regionkey // 3 = 0 then 'part 1' else 'part 2' end as part
       from customer c left join nation n on c.c_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey""",
)
def txt27(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("word_index"), F.col("c_name").alias("word"), F.col("c_nationkey").alias("topic_index"))
    topics = table(spark, sf, "nation").select(F.col("n_nationkey").alias("topic_index"), F.col("n_name").alias("topic"), F.col("n_regionkey").alias("chapter_index"))
    chapter_part = F.floor(F.col("r_regionkey") / 3).cast("bigint").alias("part_index")
    chapters = table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("chapter_index"), F.col("r_name").alias("chapter"), chapter_part)
    parts = chapters.select("part_index", F.concat(F.lit("part "), (F.col("part_index") + 1).cast("string")).alias("part")).distinct()
    j = CP.with_hierarchy(c, topics, chapters, parts)
    return j.select("word_index", "word", "topic_index", "topic", "chapter_index", "chapter", "part_index", "part")


# ------------------------------------------------------------- TXT-28 -----

@query(
    "txt28_clean_deck",
    """select p_partkey, case when p_type = 'PROMO' then lower(p_brand) else p_brand end as word,
              replace('"' || p_name || '"', '"', '') as translation from part""",
)
def txt28(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("word"), F.when(F.col("p_type") == "PROMO", "verb").otherwise("noun").alias("pos"),
        F.concat(F.lit('"'), F.col("p_name"), F.lit('"')).alias("translation"), "p_size",
    )
    return DJ.clean_deck(p, "word", "pos", ["translation"], ["pos", "p_size"])


# ------------------------------------------------------------- UP-09 ------

@query(
    "up09_replace_from",
    f"""with n as {V_NOTE_SQL}, r as (select cast(floor(idx) as bigint) as block, translation from n where idx = floor(idx) and word <> 'P')
       select c.idx, c.word, r.translation from n c left join r on cast(floor(c.idx) as bigint) = r.block where c.idx <> floor(c.idx)""",
)
def up09(spark, sf):
    n = v_note(spark, sf)
    kids = n.where(~ix.is_root("idx")).withColumn("block", ix.root("idx")).select("idx", "word", "translation", "block")
    lookup = n.where(ix.is_root("idx") & (F.col("word") != "P")).select(ix.root("idx").alias("block"), "translation")
    return J.replace_from(kids, lookup, "block", ["translation"]).select("idx", "word", "translation")


@query(
    "txt16_prepare_requests",
    f"""with l as (select cast(row_number() over (order by doc_id, pos) as {D}) as idx, sentence from {V_LINE_SQL}),
            todo as (select idx, string_split(sentence, ' ')[1] as word, md5(cast(idx as varchar) || ':7') as h from l where not length(sentence) between 60 and 70),
            b as (select *, cast(floor((row_number() over (order by h, idx) - 1) / 70) as bigint) as block from todo)
       select block, json_object('model', 'text-generator', 'messages', [json_object('role', 'user', 'content', 'Write one sentence per word:'),
              json_object('role', 'user', 'content', string_agg(cast(idx as varchar) || '|' || word, chr(10) order by h, idx))])::varchar as request
       from b group by block""",
)
def txt16(spark, sf):
    deck = v_line_idx(spark, sf).select(
        "idx",
        F.split_part("sentence", F.lit(" "), F.lit(1)).alias("word"),
        F.when(S.length_between("sentence", 60, 70), F.col("sentence")).alias("sentence"),
    )
    return CP.prepare_requests(deck, "idx", ["word"], "sentence", "Write one sentence per word:", "text-generator", 70, seed=7)


# a response of every fifth order has no content, the word of every seventh
# order's rows is blank
@query(
    "txt17_ingest_responses",
    f"""with deck as (select cast(o_orderkey as {D}) as idx, o_orderstatus as word, cast(null as varchar) as sentence from orders),
            resp as (select cast(l_orderkey as {D}) as idx, arg_min(l_returnflag || ' ' || cast(l_linenumber as varchar), l_linenumber * 1000 + ascii(l_returnflag)) as sentence
                     from lineitem where l_orderkey % 5 <> 0 and l_orderkey % 7 <> 0 group by l_orderkey)
       select d.idx, case when r.idx is not null then 'X' else {strip_sql('d.word')} end as word,
              case when r.idx is not null then {strip_sql('r.sentence')} else d.sentence end as sentence
       from deck d left join resp r on d.idx = r.idx""",
)
def txt17(spark, sf):
    return _ingested(spark, sf)[0]


@query("txt17_invalid_responses", "select distinct l_orderkey from lineitem where l_orderkey % 5 = 0")
def txt17_invalid(spark, sf):
    return _ingested(spark, sf)[1].select("l_orderkey")


def _ingested(spark, sf):
    o = table(spark, sf, "orders")
    deck = o.select(F.col("o_orderkey").cast(D).alias("idx"), F.col("o_orderstatus").alias("word"), F.lit(None).cast("string").alias("sentence"))
    li = table(spark, sf, "lineitem")
    # one fenced response per order; every line is "| idx | word | flag n |"
    word = F.when(F.col("l_orderkey") % 7 == 0, F.lit(" ")).otherwise(F.lit("X"))
    row = F.format_string("| %s | %s | %s %s |", F.col("l_orderkey").cast(D).cast("string"), word, "l_returnflag", F.col("l_linenumber").cast("string"))
    g = li.select("l_orderkey", "l_linenumber", row.alias("row")).groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "row"))), lambda s: s["row"]), "\n").alias("body")
    )
    content = F.concat(F.lit("```csv\nidx | word | sentence\n"), F.col("body"), F.lit("\n```"))
    message = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    full = F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))
    resp = g.select("l_orderkey", F.when(F.col("l_orderkey") % 5 == 0, F.lit('{"error": "timeout"}')).otherwise(full).alias("response"))
    return CP.ingest_responses(deck, resp, "response", "l_orderkey", f"idx {D}, word string, sentence string")
