"""Queries for the column functions: STR, ARR, MAP, JSN and the UDF surface."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays as A
from ..functions import index as ix
from ..functions import text as S
from ..operators import udf as U
from ..schema import DROPPED_TOKENS
from .catalog import query
from .q_core import _base_form_sql, strip_sql
from .views import V_LINE_SQL, V_NOTE_SQL, V_TOK_SQL, table, v_line, v_note, v_tok

D = "decimal(18,6)"
PIPE_PARTS_SQL = """(select doc_id, cast(u.k as bigint) as k, u.part from documents,
    lateral (select unnest(string_split(text, '|')) as part, generate_subscripts(string_split(text, '|'), 1) as k) u)"""


def _pipe_parts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(A.split_literal("text", "|")).alias("k", "part")).withColumn("k", (F.col("k") + 1).cast("bigint"))


# --------------------------------------------------------------- STR ------

@query("str01_strip", f"select doc_id, k, {strip_sql('part')} as part from {PIPE_PARTS_SQL}")
def str01(spark, sf):
    return _pipe_parts(spark, sf).withColumn("part", S.strip("part"))


@query("str02_strip_chars", f"select doc_id, pos, trim(sentence, '|. ') as core from {V_LINE_SQL}")
def str02(spark, sf):
    return v_line(spark, sf).select("doc_id", "pos", S.strip_chars("sentence", "|. ").alias("core"))


@query("str03_lower", "select p_partkey, lower(p_brand) as brand, lower(p_type) as type from part")
def str03(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.lower("p_brand").alias("brand"), S.lower("p_type").alias("type"))


@query("str04_replace", f"select doc_id, pos, replace(sentence, 'the', 'THE') as sentence from {V_LINE_SQL}")
def str04(spark, sf):
    return v_line(spark, sf).withColumn("sentence", S.replace("sentence", "the", "THE"))


@query("str05_escape_newlines", "select doc_id, replace(text, chr(10), '\\n') as text from documents")
def str05(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.escape_newlines("text").alias("text"))


@query("str06_interpolate", "select p_partkey, p_name || ' (' || p_brand || ', size ' || cast(p_size as varchar) || ')' as label from part")
def str06(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.interpolate("%s (%s, size %s)", "p_name", "p_brand", F.col("p_size").cast("string")).alias("label"))


MEDIA_SQL = "'pictures___' || replace(lower(p_type), ' ', '-') || '___' || replace(lower(p_name), ' ', '-') || '.jpg'"


@query("str07_media_name", f"select p_partkey, {MEDIA_SQL} as media from part")
def str07(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.media_name("p_type", "p_name", "pictures").alias("media"))


@query("str08_image_tag", f"select p_partkey, '<img src=\"' || {MEDIA_SQL} || '\">' as image from part")
def str08(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.image_tag(S.media_name("p_type", "p_name", "pictures")).alias("image"))


@query("str09_length", "select doc_id, cast(length(text) as bigint) as len, n_chars from documents")
def str09(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.length("text").alias("len"), "n_chars")


@query("str10_substr", "select p_partkey, substr(p_name, 1, 3) as head, substr(p_brand, 7, 2) as brand_no from part")
def str10(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.substr("p_name", 1, 3).alias("head"), S.substr("p_brand", 7, 2).alias("brand_no"))


CUT_SQL = f"(case when regexp_matches(sentence, '[.(,]') then {strip_sql(chr(39).join(['regexp_extract(sentence, ', '^([^.(,]*)', ', 1)']))} else sentence end)"


@query("str11_cut_annotation", f"select doc_id, pos, {CUT_SQL} as head from {V_LINE_SQL}")
def str11(spark, sf):
    return v_line(spark, sf).select("doc_id", "pos", S.cut_annotation("sentence").alias("head"))


BIGRAM_SQL = f"""(select doc_id, pos, cast(u.k as bigint) as k, u.phrase from
    (select doc_id, pos, string_split(sentence, ' ') as t from {V_LINE_SQL}),
    lateral (select unnest(list_transform(range(1, len(t) + 1), lambda k: t[k] || coalesce(' ' || t[k + 1], ''))) as phrase,
                    unnest(range(1, len(t) + 1)) as k) u)"""


def _bigrams(spark, sf):
    """Every token with its successor ("der Hund", "Hund bellt", ...)."""
    l = v_line(spark, sf).withColumn("t", F.split("sentence", " "))
    ph = F.transform("t", lambda x, i: F.concat_ws(" ", x, F.try_element_at("t", i + 2)))
    return l.select("doc_id", "pos", F.posexplode(ph).alias("k", "phrase")).withColumn("k", (F.col("k") + 1).cast("bigint"))


@query("str12_base_form", f"select doc_id, pos, k, phrase, {_base_form_sql('phrase')} as base from {BIGRAM_SQL}")
def str12(spark, sf):
    return _bigrams(spark, sf).withColumn("base", S.base_form("phrase"))


@query(
    "str13_keep_word_chars",
    "select doc_id, regexp_replace(replace(text, chr(10), ' '), '[^\\p{L}\\p{N} -]', '', 'g') as clean from documents",
)
def str13(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.keep_word_chars("text").alias("clean"))


@query(
    "str14_initial_tests",
    f"""select regexp_matches(token, '^\\p{{Lu}}') as capitalised, regexp_matches(token, '^\\p{{Nd}}') as digit,
              cast(count(*) as bigint) as n from {V_TOK_SQL} group by 1, 2""",
)
def str14(spark, sf):
    t = v_tok(spark, sf)
    return t.groupBy(S.is_capitalised("token").alias("capitalised"), S.starts_with_digit("token").alias("digit")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")
    )


def _pad_sql(x: str, w: int) -> str:
    return f"(case when length(cast({x} as varchar)) >= {w} then cast({x} as varchar) else lpad(cast({x} as varchar), {w}, '0') end)"


@query("str15_pad", f"select o_orderkey, {_pad_sql('o_orderkey', 4)} as id4, {_pad_sql('o_custkey', 5)} as cust5 from orders")
def str15(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", S.pad("o_orderkey", 4).alias("id4"), S.pad("o_custkey", 5).alias("cust5"))


@query("str16_fixed", f"select idx, cast(cast(idx as decimal(18,3)) as varchar) as fixed3 from {V_NOTE_SQL}")
def str16(spark, sf):
    return v_note(spark, sf).select("idx", S.fixed("idx", 3).alias("fixed3"))


@query(
    "str17_index_label",
    f"select idx, regexp_replace(regexp_replace(cast(idx as varchar), '0+$', ''), '\\.$', '') as label from {V_NOTE_SQL}",
)
def str17(spark, sf):
    return v_note(spark, sf).select("idx", S.index_label("idx").alias("label"))


@query("str18_token_count", "select doc_id, cast(len(string_split(text, ' ')) as bigint) as tokens from documents")
def str18(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.token_count("text").alias("tokens"))


SPLIT_SENT_SQL = f"""(select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)),
                       lambda x: {strip_sql('x')}), lambda x: x <> '') as s from documents)"""


@query(
    "str19_split_sentences",
    f"""select doc_id, cast(u.i as bigint) as i, u.sentence from {SPLIT_SENT_SQL},
        lateral (select unnest(s) as sentence, generate_subscripts(s, 1) as i) u""",
)
def str19(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", S.split_sentences("text").alias("s"))
    return d.select("doc_id", F.posexplode("s").alias("i", "sentence")).withColumn("i", (F.col("i") + 1).cast("bigint"))


_BARE = "regexp_replace(regexp_replace({x}, '^[^\\p{{L}}\\p{{N}}]+', ''), '[^\\p{{L}}\\p{{N}}.!?]+\\z', '')"
_KIND = "regexp_replace(lower(regexp_replace({x}, '\\.\\z', '')), '\\d+([.,]\\d+)*', '0', 'g')"
_PLAIN = "regexp_replace({x}, '[!?]+\\z', '')"
LEARNED_SENTENCES_SQL = f"""
       with l as (select distinct md5(text) as tid, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents),
            t as (select tid, n, list_filter(regexp_split_to_array(line, '[ \\t\\r]+'), lambda x: x <> '') as toks from l),
            w as (select tid, n, unnest(toks) as word, generate_subscripts(toks, 1) as i from t),
            b as (select tid, n, i, {_BARE.format(x='word')} as bare,
                         lag({_BARE.format(x='word')}) over (partition by tid, n order by i) as prev,
                         lead({_BARE.format(x='word')}) over (partition by tid, n order by i) as next, word from w),
            k as (select {_KIND.format(x=_PLAIN.format(x='bare'))} as kind, ends_with(bare, '.') and not ends_with(bare, '..') as stop,
                         regexp_matches(bare, '^\\p{{Ll}}') as small,
                         prev is not null and not regexp_matches(prev, '[.!?]\\z') and regexp_matches(bare, '^\\p{{Lu}}') as capital
                  from b where regexp_matches(bare, '[\\p{{L}}\\p{{N}}]')),
            c as (select kind, count(*) filter (where stop) as a, count(*) filter (where not stop) as z,
                         count(*) filter (where small) as small, count(*) filter (where capital) as capital,
                         length(kind) - length(replace(kind, '.', '')) as dots from k group by kind),
            p as (select least(greatest(sum(a) / sum(a + z), 1e-9), 1 - 1e-9) as p from c),
            m as (select kind, a > 0 and 2 * (a * ln(0.99 / p) + z * ln((1 - 0.99) / (1 - p))) * exp(-(length(kind) - dots)) * (dots + 1)
                                      * pow(length(kind) - dots, -z) >= 0.3 as short, small > 0 and capital = 0 as starter from c, p),
            e as (select b.*, ends_with(bare, '.') and (ends_with(bare, '..') or coalesce(m1.short, false)) as unsure,
                         regexp_matches(next, '^\\p{{Lu}}') and coalesce(m2.starter, false) as begins
                  from b left join m m1 on m1.kind = {_KIND.format(x='bare')} left join m m2 on m2.kind = {_KIND.format(x=_PLAIN.format(x='next'))}),
            s as (select tid, n, i, word, coalesce(sum((regexp_matches(bare, '[.!?]\\z') and next is not null and (not unsure or begins))::int)
                         over (partition by tid, n order by i rows between unbounded preceding and 1 preceding), 0) as k from e),
            g as (select tid, n, k, string_agg(word, ' ' order by i) as sentence from s group by tid, n, k)
       select d.doc_id, row_number() over (partition by d.doc_id, d.rid order by n, k) as i, sentence
       from (select *, row_number() over () as rid from documents) d join g on md5(d.text) = g.tid"""


@query("str19_learned_sentences", LEARNED_SENTENCES_SQL)
def str19l(spark, sf):
    """With the abbreviations that the documents themselves teach."""
    from ..operators.sentences import learn_sentence_ends, split_sentences, text_lines

    docs = table(spark, sf, "documents").select("doc_id", "text")
    lines = text_lines(docs)
    return split_sentences(docs, learn_sentence_ends(docs, lines=lines), lines=lines).select("doc_id", "i", "sentence")


@query(
    "str20_fix_sentence",
    f"""select doc_id, pos, case when ends_with(s, '"') then replace(s, '/', '.') || '.' else replace(s, '/', '.') end as fixed
       from (select doc_id, pos, sentence || case when contains(sentence, ',') then '/x "q"' else '' end as s from {V_LINE_SQL})""",
)
def str20(spark, sf):
    l = v_line(spark, sf).withColumn("s", F.concat("sentence", F.when(F.col("sentence").contains(","), F.lit('/x "q"')).otherwise(F.lit(""))))
    return l.select("doc_id", "pos", S.fix_sentence("s").alias("fixed"))


@query("str21_escape_quotes", "select page_id, replace(html, '\"', '\"\"') as html from pages")
def str21(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.escape_quotes("html").alias("html"))


@query(
    "str22_clean_lines",
    f"""select doc_id, {strip_sql("array_to_string(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '\\s+$', '')), chr(10))")} as text
       from (select doc_id, replace(text, '. ', ' ' || chr(10)) as t from documents)""",
)
def str22(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit(" \n")).alias("t"))
    return d.select("doc_id", S.clean_lines("t").alias("text"))


@query(
    "str23_url_basename",
    f"""select page_id, string_split(url, '/')[-1] as base,
              'https://stories.example/' || {_pad_sql('page_id', 3)} as assembled from pages""",
)
def str23(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", S.url_basename("url").alias("base"), S.url_join(F.lit("https://stories.example/"), F.col("page_id"), 3).alias("assembled"))


@query("str24_url_quote", "select item_id, replace(url_encode(text), '%2F', '/') as quoted from benchmark")
def str24(spark, sf):
    b = table(spark, sf, "benchmark")
    return b.select("item_id", S.url_quote("text").alias("quoted"))


@query(
    "str25_url_endpoint",
    """select page_id, coalesce(nullif(regexp_extract(url, '^https?://[^/]+/v\\d+/(.+)$', 1), ''),
                              nullif(regexp_extract(url, '^https?://[^/]+/[^/]+/(.+)$', 1), '')) as endpoint from pages""",
)
def str25(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.url_endpoint("url").alias("endpoint"))


@query(
    "str26_strip_fences",
    """select conv_id, turn, replace(replace(replace('```csv' || chr(10) || text || chr(10) || '```', '```csv', ''), '```text', ''), '```', '') as body
       from conversations""",
)
def str26(spark, sf):
    c = table(spark, sf, "conversations")
    fenced = F.concat(F.lit("```csv\n"), F.col("text"), F.lit("\n```"))
    return c.select("conv_id", "turn", S.strip_fences(fenced).alias("body"))


@query(
    "str27_clean_row",
    f"""select doc_id, pos, replace({strip_sql(f"trim({strip_sql('sentence')}, '|')")}, ' | ', '|') as row
       from {V_LINE_SQL}""",
)
def str27(spark, sf):
    return v_line(spark, sf).select("doc_id", "pos", S.clean_row("sentence").alias("row"))


@query(
    "str28_range_label",
    """select band, 'the ' || cast(min(p_size) as varchar) || 'st to the ' || cast(max(p_size) as varchar) || 'th' as label from (
         select p_size, case when p_size <= 17 then 1 when p_size <= 34 then 2 else 3 end as band from part) group by band""",
)
def str28(spark, sf):
    p = table(spark, sf, "part")
    band = F.when(F.col("p_size") <= 17, 1).when(F.col("p_size") <= 34, 2).otherwise(3)
    g = p.groupBy(band.alias("band")).agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))
    return g.select("band", S.range_label("lo", "hi").alias("label"))


@query(
    "str29_mkrange",
    """select o_orderkey, '[ ' || cast(o_orderkey * 10 + 5 as varchar) || ' ; ' || cast(least(o_orderkey * 10 + 5 + o_custkey // 100, 500000) as varchar) || ' )' as label from orders""",
)
def str29(spark, sf):
    o = table(spark, sf, "orders")
    lab = S.mkrange(F.col("o_orderkey") * 10, F.col("o_orderkey") * 10 + F.floor(F.col("o_custkey") / 100).cast("bigint"), maxi=500000, offset=5)
    return o.select("o_orderkey", lab.alias("label"))


@query(
    "str30_field_as_int",
    """select o_orderkey, try_cast(regexp_replace(split_part('note ' || cast(o_orderkey as varchar) || ': loaded', ' ', 2), '.$', '') as integer) as id
       from orders""",
)
def str30(spark, sf):
    o = table(spark, sf, "orders")
    line = F.concat(F.lit("note "), F.col("o_orderkey").cast("string"), F.lit(": loaded"))
    return o.select("o_orderkey", S.field_as_int(line, 2).alias("id"))


# --------------------------------------------------------------- ARR ------

@query(
    "arr01_explode_tokens",
    """select p_partkey, cast(u.i as bigint) as i, u.token from (select p_partkey, case when p_size > 45 then null else p_name end as n from part),
       lateral (select unnest(coalesce(string_split(n, ' '), [null])) as token, generate_subscripts(coalesce(string_split(n, ' '), [null]), 1) - 1 as i) u""",
)
def arr01(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 45, None).otherwise(F.col("p_name")).alias("n"))
    x = p.select("p_partkey", F.posexplode_outer(F.split("n", " ")).alias("i", "token"))
    return x.select("p_partkey", F.coalesce(F.col("i"), F.lit(0)).cast("bigint").alias("i"), "token")


@query("arr02_array_join", f"select doc_id, pos, string_agg(token, ' ' order by i) as sentence from {V_TOK_SQL} group by doc_id, pos")
def arr02(spark, sf):
    """Lines are gathered by key as they are and cut into tokens after that."""
    g = v_line(spark, sf).groupBy("doc_id", "pos").agg(F.collect_list("sentence").alias("__s"))
    tokens = F.transform("__s", lambda s: F.transform(F.split(s, " "), lambda t, i: F.struct(i.alias("i"), t.alias("token"))))
    g = g.withColumn("__t", F.sort_array(F.flatten(tokens)))
    return g.select("doc_id", "pos", F.array_join(F.transform("__t", lambda s: s["token"]), " ").alias("sentence"))


DROP_LIST_SQL = "[" + ", ".join("'" + t + "'" for t in DROPPED_TOKENS + ["", "the"]) + "]"


@query(
    "arr03_drop_tokens",
    f"select doc_id, pos, array_to_string(list_filter(string_split(sentence, ' '), lambda x: not list_contains({DROP_LIST_SQL}, x)), ' ') as kept from {V_LINE_SQL}",
)
def arr03(spark, sf):
    l = v_line(spark, sf)
    kept = A.drop_tokens(F.split("sentence", " "), DROPPED_TOKENS + ["", "the"])
    return l.select("doc_id", "pos", F.array_join(kept, " ").alias("kept"))


@query(
    "arr04_transform",
    "select doc_id, array_to_string(list_transform(string_split(text, '|'), lambda x: trim(x)), '|') as cells from documents",
)
def arr04(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.array_join(F.transform(A.split_literal("text", "|"), lambda x: F.trim(x)), "|").alias("cells"))


@query("arr05_array_contains", "select doc_id, list_contains(string_split(text, ' '), 'und') as has_und from documents")
def arr05(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_contains(F.split("text", " "), "und").alias("has_und"))


@query("arr06_slice", "select doc_id, array_to_string(list_slice(string_split(text, chr(10)), 1, 3), chr(10)) as head from documents")
def arr06(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.slice(F.split("text", "\n"), 1, 3), "\n").alias("head"))


@query(
    "arr07_zip",
    """select doc_id, cast(least(len(a), len(b)) as bigint) as n_pairs,
              array_to_string(list_transform(list_slice(list_zip(a, b), 1, least(len(a), len(b))), lambda p: p[1] || ' <> ' || p[2]), chr(10)) as pairs
       from (select doc_id, string_split(text, chr(10)) as a, string_split(text, '. ') as b from documents)""",
)
def arr07(spark, sf):
    d = table(spark, sf, "documents")
    z = A.zip_shortest(F.split("text", "\n"), F.split("text", r"\. "))
    pairs = F.array_join(F.transform(z, lambda p: F.concat_ws(" <> ", p.getField("0"), p.getField("1"))), "\n")
    return d.select("doc_id", F.size(z).cast("bigint").alias("n_pairs"), pairs.alias("pairs"))


@query(
    "arr08_pad_array",
    "select doc_id, cast(len(string_split(text, chr(10))) + 4 as bigint) as n, '|' || chr(10) || chr(10) || text || chr(10) || chr(10) || '|' as padded from documents",
)
def arr08(spark, sf):
    d = table(spark, sf, "documents")
    p = A.pad_array(F.split("text", "\n"), 2)
    return d.select("doc_id", F.size(p).cast("bigint").alias("n"), F.concat(F.lit("|"), F.array_join(p, "\n"), F.lit("|")).alias("padded"))


@query(
    "arr09_leading_blanks",
    """select doc_id,
          cast(coalesce(list_position(list_transform(a, lambda x: trim(x) <> ''), true) - 1, len(a)) as integer) as leading,
          cast(coalesce(list_position(list_transform(list_reverse(a), lambda x: trim(x) <> ''), true) - 1, len(a)) as integer) as trailing
       from (select doc_id, string_split(text, '|') as a from documents)""",
)
def arr09(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", A.split_literal("text", "|").alias("a"))
    return d.select("doc_id", A.leading_blanks("a").alias("leading"), A.trailing_blanks("a").alias("trailing"))


@query(
    "arr10_set_at",
    "select doc_id, pos, array_to_string(['#'] || list_slice(string_split(sentence, ' '), 2, len(string_split(sentence, ' '))), ' ') as s from " + V_LINE_SQL,
)
def arr10(spark, sf):
    l = v_line(spark, sf)
    return l.select("doc_id", "pos", F.array_join(A.set_at(F.split("sentence", " "), 0, "#"), " ").alias("s"))


@query(
    "arr11_sum_lengths",
    "select doc_id, cast(list_sum(list_transform(string_split(text, chr(10)), lambda x: length(x) + 1)) as bigint) as chars from documents",
)
def arr11(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", A.sum_lengths(F.split("text", "\n"), 1).alias("chars"))


@query(
    "arr12_flatten_lines",
    """select conv_id, turn, cast(u.k as bigint) as k, u.line from conversations,
       lateral (select unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as k) u""",
)
def arr12(spark, sf):
    c = table(spark, sf, "conversations")
    x = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    return x.withColumn("k", (F.col("k") + 1).cast("bigint"))


@query(
    "arr13_expand_series",
    f"""select p_partkey, cast(n as bigint) as n, 'https://stories.example/' || cast(p_partkey as varchar) || '/' || {_pad_sql('n', 3)} as url
       from part, lateral (select unnest(range(1, p_size + 1)) as n)""",
)
def arr13(spark, sf):
    p = table(spark, sf, "part")
    x = p.select("p_partkey", F.explode(A.series("p_size")).alias("n")).withColumn("n", F.col("n").cast("bigint"))
    url = F.concat(F.lit("https://stories.example/"), F.col("p_partkey").cast("string"), F.lit("/"), S.pad("n", 3))
    return x.withColumn("url", url)


# --------------------------------------------------------------- MAP ------

@query(
    "map01_zip_map_merge",
    """select o_orderkey, o_orderpriority || '!' as priority, o_orderstatus as status from orders""",
)
def map01(spark, sf):
    o = table(spark, sf, "orders")
    base = A.zip_map(F.array(F.lit("status"), F.lit("priority")), F.array("o_orderstatus", "o_orderpriority"))
    patch = F.create_map(F.lit("priority"), F.concat("o_orderpriority", F.lit("!")))
    merged = A.map_merge(base, patch)
    return o.select("o_orderkey", A.map_get(merged, "priority").alias("priority"), A.map_get(merged, "status").alias("status"))


@query(
    "map02_map_get",
    """select event_id, coalesce(cast(json_extract_string(props, '$.k') as integer), 0) as k,
              coalesce(cast(json_extract_string(props, '$.missing') as integer), -1) as missing from events""",
)
def map02(spark, sf):
    e = table(spark, sf, "events")
    m = F.from_json("props", "map<string,int>")
    return e.select("event_id", A.map_get(m, "k", 0).alias("k"), A.map_get(m, "missing", -1).alias("missing"))


# --------------------------------------------------------------- JSN ------

def _responses(spark, sf):
    """Conversation turns packed as model responses; system turns become
    error objects without choices."""
    c = table(spark, sf, "conversations")
    ok = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("role"), F.col("text").alias("content")).alias("message"))).alias("choices")))
    err = F.to_json(F.struct(F.struct(F.col("text").alias("message")).alias("error")))
    return c.select("conv_id", "turn", "role", F.when(F.col("role") == "system", err).otherwise(ok).alias("response"))


@query("jsn01_response_text", "select conv_id, turn, text as content from conversations where role <> 'system'")
def jsn01(spark, sf):
    r = _responses(spark, sf).select("conv_id", "turn", A.response_text("response").alias("content"))
    return r.where(F.col("content").isNotNull())


@query("jsn02_invalid_responses", "select conv_id, turn from conversations where role = 'system'")
def jsn02(spark, sf):
    r = _responses(spark, sf)
    return r.where(~A.is_valid_response("response")).select("conv_id", "turn")


@query(
    "jsn03_to_request",
    "select conv_id, turn, json_object('model', 'text-generator', 'messages', [json_object('role', 'user', 'content', 'Translate:'), json_object('role', 'user', 'content', text)])::varchar as request from conversations",
)
def jsn03(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", A.to_request(F.lit("Translate:"), F.col("text"), "text-generator").alias("request"))


@query(
    "jsn04_pack_result",
    """select conv_id, turn, case when role = 'system' then to_json(['q' || cast(turn as varchar), text, role])::varchar
                                 else to_json(['q' || cast(turn as varchar), text])::varchar end as result from conversations""",
)
def jsn04(spark, sf):
    c = table(spark, sf, "conversations")
    meta = F.when(F.col("role") == "system", F.col("role"))
    req = F.concat(F.lit("q"), F.col("turn").cast("string"))
    return c.select("conv_id", "turn", A.pack_result(req, F.col("text"), meta).alias("result"))


@query("dq08_check_responses", "select conv_id, turn from conversations where role = 'system'")
def dq08(spark, sf):
    from ..operators.checks import check_responses

    r = _responses(spark, sf).withColumn("valid", A.is_valid_response("response"))
    return check_responses(r).select("conv_id", "turn")


# --------------------------------------------------------------- UDF ------

@query(
    "udf01_map_column",
    f"select doc_id, pos, case when pos % 5 > 0 then strip_accents(sentence) end as plain from {V_LINE_SQL}",
)
def udf01(spark, sf):
    """Letters without their marks: no built-in does this."""
    l = v_line(spark, sf).select("doc_id", "pos", F.when(F.col("pos") % 5 > 0, F.col("sentence")).alias("s"))
    return U.map_column(l, "s", U.without_accents, "plain").drop("s")


@query("udf02_map_rows", "select p_partkey, round(jaro_similarity(p_name, p_type), 9) as alike from part")
def udf02(spark, sf):
    """A similarity of two columns that built-ins lack."""
    p = table(spark, sf, "part")
    alike = U.map_rows(p, ["p_name", "p_type"], lambda r: U.jaro(r["p_name"], r["p_type"]), "alike", T.DoubleType())
    return alike.select("p_partkey", F.round("alike", 9).alias("alike"))


@query(
    "udf03_apply_groups",
    """select l_partkey, string_agg(distinct l_returnflag, ';' order by l_returnflag) as flags, cast(count(*) as bigint) as n from lineitem group by l_partkey""",
)
def udf03(spark, sf):
    """Parts of any number of lines: each batch is folded before the shuffle,
    all parts of a batch at once."""
    import pandas as pd

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        flags = pdf[["l_partkey", "l_returnflag"]].dropna(subset=["l_returnflag"])
        flags = flags.assign(l_returnflag=flags["l_returnflag"].str.split(";")).explode("l_returnflag").drop_duplicates().sort_values("l_returnflag")
        several = flags.duplicated("l_partkey", keep=False)
        joined = flags[several].groupby("l_partkey", dropna=False, sort=False)["l_returnflag"].agg(";".join).reset_index()
        flags = pd.concat([flags[~several], joined])
        n = pdf.groupby("l_partkey", dropna=False, sort=False)["n"].sum().reset_index()
        return n.merge(flags, on="l_partkey", how="left")[["l_partkey", "l_returnflag", "n"]]

    li = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("long"), F.col("l_returnflag").cast("string"))
    schema = "l_partkey long, l_returnflag string, n long"
    out = U.apply_groups(li, "l_partkey", merged, schema, lambda g: merged(g.assign(n=1)), schema, many=True)
    return out.withColumnRenamed("l_returnflag", "flags")


@query(
    "udf04_order_by_key",
    f"select idx, row_number() over (order by floor(idx), (case when idx - floor(idx) = 0 then -1 else length(regexp_extract(cast(cast(idx - floor(idx) as {D}) as varchar), '\\.(0*)', 1)) end), idx - floor(idx), word, translation, rank) as pos from {V_NOTE_SQL}",
)
def udf04(spark, sf):
    from ..operators.window import number_rows

    n = v_note(spark, sf).withColumn("__r", ix.root("idx"))
    key = U.order_by_key(F.col("idx"))
    x = number_rows(n, [], [*key, "word", "translation", "rank"], "pos")
    return x.select("idx", "pos")


@query(
    "udf05_pluggable_step",
    f"select doc_id, pos, lower({strip_sql('sentence')}) as sentence from {V_LINE_SQL} where length({strip_sql('sentence')}) > 0",
)
def udf05(spark, sf):
    steps = [
        lambda df: df.withColumn("sentence", S.strip("sentence")),
        lambda df: df.where(F.char_length("sentence") > 0),
        lambda df: df.withColumn("sentence", F.lower("sentence")),
    ]
    return U.apply_steps(v_line(spark, sf), steps)


@query(
    "udf07_table_function",
    f"""select doc_id, cast(u.i as bigint) as i, u.line from (
          select doc_id, string_split(list_reduce(string_split(sentence, ' '), lambda a, w:
                   case when length(string_split(a, chr(10))[-1]) + 1 + length(w) <= 40 then a || ' ' || w else a || chr(10) || w end), chr(10)) as lines
          from {V_LINE_SQL} where pos = 1),
        lateral (select unnest(lines) as line, generate_subscripts(lines, 1) as i) u""",
)
def udf07(spark, sf):
    """Titles (first lines) wrapped to lines of forty characters."""
    titles = v_line(spark, sf).where("pos = 1").select("doc_id", "sentence")
    return U.explode_with(titles, "doc_id", "sentence", lambda t: U.wrap_words(t, 40))
