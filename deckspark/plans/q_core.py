"""Queries for projections, filters, updates, joins, aggregates, sets and
column functions (PJ, FL, UP, JN, AGG, SE, STR, ARR, MAP, JSN, MTH)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import text as S
from ..operators import agg as G
from ..operators import columns as P
from ..operators import joins as J
from ..operators import window as W
from ..schema import language_columns
from ..session import cut_lineage
from .catalog import query

from .views import V_LINE_SQL, V_TOK_SQL, table, v_line, v_tok

STRIP_SQL = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip_sql(x: str) -> str:
    return STRIP_SQL.format(x=x)


# ---------------------------------------------------------------- PJ ------

@query("pj01_select_columns", "select s_name, s_suppkey, s_acctbal from supplier")
def pj01(spark, sf):
    return table(spark, sf, "supplier").select("s_name", "s_suppkey", "s_acctbal")


@query("pj02_rename", "select c_custkey as customer_id, c_name as name, c_mktsegment as segment from customer")
def pj02(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return df.withColumnsRenamed({"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "segment"})


@query("pj03_rename_positional", "select s_suppkey as id, s_name as word, s_nationkey as topic_id, s_acctbal as score from supplier")
def pj03(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").toDF("id", "word", "topic_id", "score")


@query("pj04_drop", "select c_custkey, c_name, c_nationkey from customer")
def pj04(spark, sf):
    return table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment")


@query(
    "pj05_with_column",
    "select p_partkey, p_name, p_brand || ' ' || p_type as label, cast(p_size * 2 as bigint) as double_size from part",
)
def pj05(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_name", F.concat_ws(" ", "p_brand", "p_type").alias("label"), (F.col("p_size") * 2).cast("bigint").alias("double_size"))


@query(
    "pj06_insert_column",
    "select o_orderkey, o_custkey, o_orderstatus as word_actual, o_orderstatus, o_orderpriority from orders",
)
def pj06(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return P.insert_column(o, 2, "word_actual", F.col("o_orderstatus"))


@query(
    "pj07_language_names",
    "select item_id, split_part(text, ' ', 1) as word_deu, text as sentence_deu, lower(text) as sentence_eng from benchmark",
)
def pj07(spark, sf):
    b = table(spark, sf, "benchmark")
    roles = b.select("item_id", F.split_part("text", F.lit(" "), F.lit(1)).alias("word_1"), F.col("text").alias("sentence_1"), F.lower("text").alias("sentence_2"))
    m = language_columns("deu", "eng")
    return roles.withColumnsRenamed({k: v for k, v in m.items() if k in roles.columns})


@query("pj08_promote_index", "select cast(o_orderkey as decimal(18,6)) as idx, o_orderstatus, o_totalprice from orders")
def pj08(spark, sf):
    o = table(spark, sf, "orders")
    return P.promote_index(o.select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey")


@query("pj08_demote_index", "select o_orderstatus, cast(o_orderkey as bigint) as o_orderkey from orders")
def pj08_back(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return P.demote_index(P.promote_index(o, "o_orderkey"), "o_orderkey")


@query("pj09_trim_all", f"select item_id, {strip_sql('text')} as text from benchmark")
def pj09(spark, sf):
    return P.trim_all(table(spark, sf, "benchmark"))


@query(
    "pj10_cast_columns",
    "select cast(l_orderkey as decimal(18,6)) as idx, cast(l_linenumber as varchar) as linenumber, cast(l_quantity as bigint) as quantity from lineitem",
)
def pj10(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("decimal(18,6)").alias("idx"),
        F.col("l_linenumber").cast("string").alias("linenumber"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


# ---------------------------------------------------------------- FL ------

@query(
    "fl01_has_value",
    """select c.c_custkey, o.n is not null as has_orders, cast(coalesce(o.n, 0) as bigint) as n_orders
       from customer c left join (select o_custkey, count(*) as n from orders group by o_custkey) o
       on c.c_custkey = o.o_custkey""",
)
def fl01(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.select("c_custkey", F.col("n").isNotNull().alias("has_orders"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"))


@query(
    "fl02_length_between",
    f"select doc_id, pos, cast(length(sentence) as bigint) as len from {V_LINE_SQL} where sentence is not null and length(sentence) between 60 and 70",
)
def fl02(spark, sf):
    l = v_line(spark, sf)
    return l.where(S.length_between("sentence", 60, 70)).select("doc_id", "pos", S.length("sentence").alias("len"))


@query(
    "fl03_starts_with",
    f"select doc_id, pos, i, token, not starts_with(token, 'E') as keep from {V_TOK_SQL} where starts_with(token, 'E') or starts_with(token, 'T')",
)
def fl03(spark, sf):
    t = v_tok(spark, sf)
    return t.where(F.col("token").startswith("E") | F.col("token").startswith("T")).withColumn("keep", ~F.col("token").startswith("E"))


@query("fl04_contains_text", "select doc_id, lang from documents where contains(text, '|')")
def fl04(spark, sf):
    return table(spark, sf, "documents").where(F.col("text").contains("|")).select("doc_id", "lang")


@query(
    "fl05_isin",
    """select l_orderkey, l_linenumber, l_returnflag, l_returnflag in ('R', 'A') as is_listed
       from lineitem where l_linestatus not in ('O')""",
)
def fl05(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.where(~F.col("l_linestatus").isin("O")).select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_returnflag").isin("R", "A").alias("is_listed"))


def _base_form_sql(x: str) -> str:
    cut = f"(case when regexp_matches({x}, '[.(,]') then {strip_sql(f'regexp_extract({x}, ' + chr(39) + '^([^.(,]*)' + chr(39) + ', 1)')} else {x} end)"
    return f"""(case when {x} is null then null
        when {x} in ('die', 'der', 'das') then {x}
        when regexp_matches({cut}, '^\\p{{Lu}}') then {cut}
        when substr({cut}, 1, 3) in ('die', 'der', 'das') and substr({cut}, 4, 1) = ' ' and regexp_matches({cut}, '\\p{{Lu}}')
             then regexp_extract({cut}, '(?s)^[^\\p{{Lu}}]*(\\p{{Lu}}.*)$', 1)
        else {cut} end)"""


@query(
    "fl06_is_noun",
    f"select doc_id, pos, i, token from {V_TOK_SQL} where regexp_matches({_base_form_sql('token')}, '^\\p{{Lu}}')",
)
def fl06(spark, sf):
    t = v_tok(spark, sf)
    return t.where(S.base_form("token").rlike(r"^\p{Lu}"))


@query(
    "fl10_line_range",
    f"""select l.doc_id, l.pos, l.sentence from {V_LINE_SQL} l
        join (select doc_id, count(*) as n from {V_LINE_SQL} group by doc_id) c on l.doc_id = c.doc_id
        where l.pos between 2 and least(5, c.n)""",
)
def fl10(spark, sf):
    return P.line_range(v_line(spark, sf), "pos", 2, 5).select("doc_id", "pos", "sentence")


@query(
    "fl11_is_data_line",
    """select c_custkey, line from (
         select c_custkey, split_part(c_name, '#', 2) || ' | ' || c_mktsegment as line from customer
         union all select c_custkey, c_mktsegment || ' | ' || c_name from customer)
       where regexp_matches(line, '^\\p{Nd}')""",
)
def fl11(spark, sf):
    c = table(spark, sf, "customer")
    a = c.select("c_custkey", F.concat_ws(" | ", F.split_part("c_name", F.lit("#"), F.lit(2)), "c_mktsegment").alias("line"))
    b = c.select("c_custkey", F.concat_ws(" | ", "c_mktsegment", "c_name").alias("line"))
    return a.unionByName(b).where(S.starts_with_digit("line"))


@query(
    "fl12_non_blank",
    f"""select doc_id, pos, k, sentence from (select doc_id, pos, cast(u.k as bigint) as k, {strip_sql('u.s')} as sentence from {V_LINE_SQL},
          lateral (select unnest(string_split(sentence, '.')) as s, generate_subscripts(string_split(sentence, '.'), 1) as k) u)
       where trim(sentence) <> ''""",
)
def fl12(spark, sf):
    l = v_line(spark, sf).select("doc_id", "pos", F.posexplode(A.split_literal("sentence", ".")).alias("k", "s"))
    l = l.select("doc_id", "pos", (F.col("k") + 1).cast("bigint").alias("k"), S.strip("s").alias("sentence"))
    return l.where(F.trim("sentence") != "")


@query(
    "fl13_contains_lemma",
    f"select doc_id, pos from {V_LINE_SQL} where list_contains(string_split(sentence, ' '), 'the')",
)
def fl13(spark, sf):
    l = v_line(spark, sf)
    return l.where(F.array_contains(F.split("sentence", " "), "the")).select("doc_id", "pos")


@query(
    "fl15_rank_band",
    """select p_partkey, p_size, case when p_size <= 17 then 1 when p_size <= 34 then 2 else 3 end as band
       from part where p_size is not null""",
)
def fl15(spark, sf):
    p = table(spark, sf, "part")
    band = F.when(F.col("p_size") <= 17, 1).when(F.col("p_size") <= 34, 2).when(F.col("p_size") > 34, 3)
    return p.select("p_partkey", "p_size", band.alias("band")).where(F.col("band").isNotNull())


@query("fl16_search", "select p_partkey, p_name from part where regexp_matches(p_name, '(?i)BLUE|RING')")
def fl16(spark, sf):
    p = table(spark, sf, "part")
    return p.where(S.search("p_name", "BLUE|RING")).select("p_partkey", "p_name")


# ---------------------------------------------------------------- UP ------

@query(
    "up01_fill_from",
    """select d.doc_id, coalesce(l.quality, cast(d.n_chars > 2000 as integer)) as quality
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def up01(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 2000).cast("int").alias("guess"))
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return J.fill_from(j, "quality", "guess").select("doc_id", "quality")


@query(
    "up02_prefer_right",
    """select o.o_orderkey, case when r.flag is not null then r.flag else o.o_orderstatus end as o_orderstatus,
              case when r.flag is not null then r.n else 0 end as n_lines
       from orders o left join (select l_orderkey, max(l_linestatus) as flag, count(*) as n from lineitem group by l_orderkey) r
       on o.o_orderkey = r.l_orderkey""",
)
def up02(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(0).cast("bigint").alias("n_lines"))
    r = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_linestatus").alias("o_orderstatus_r"), F.count(F.lit(1)).alias("n_lines_r"))
    j = o.join(r, o.o_orderkey == r.l_orderkey, "left").drop("l_orderkey")
    return J.prefer_right(j, ["o_orderstatus", "n_lines"], "_r", flag="o_orderstatus")


@query(
    "up03_patch_rows",
    f"""select o.o_orderkey,
          case when p.o_orderkey is not null then p.o_orderstatus else {strip_sql('o.o_orderstatus')} end as o_orderstatus,
          case when p.o_orderkey is not null then null else {strip_sql('o.o_orderpriority')} end as o_orderpriority
       from orders o left join (select o_orderkey, o_orderstatus from orders where o_orderstatus = 'P') p
       on o.o_orderkey = p.o_orderkey""",
)
def up03(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    patch = o.where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("o_orderpriority"))
    return J.patch_rows(o, patch, "o_orderkey")


@query(
    "up04_tri_flag",
    """select d.doc_id, case when l.quality is null then null when l.quality = 1 then true else false end as is_good
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def up04(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    j = d.join(table(spark, sf, "labels"), "doc_id", "left")
    return j.select("doc_id", J.tri_flag(F.col("quality"), F.col("quality") == 1).alias("is_good"))


@query(
    "up05_normalize_verb",
    """select p_partkey, case when p_type = 'PROMO' and p_name is not null and not starts_with(p_name, 'to ')
              then 'to ' || p_name else p_name end as word_en from part""",
)
def up05(spark, sf):
    p = table(spark, sf, "part")
    pos = F.when(F.col("p_type") == "PROMO", "verb").otherwise("noun")
    return p.select("p_partkey", J.normalize_verb(F.col("p_name"), pos).alias("word_en"))


@query(
    "up06_compute_missing",
    """select d.doc_id, coalesce(l.quality, case when d.n_chars > 1000 then 1 else 0 end) as quality
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def up06(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    res = J.compute_missing(j, "quality", lambda x: F.when(F.col("n_chars") > 1000, 1).otherwise(0))
    return res.select("doc_id", "quality")


@query(
    "up07_blank_fields",
    f"""select doc_id, pos, case when length(sentence) between 30 and 45 then sentence end as sentence
       from {V_LINE_SQL}""",
)
def up07(spark, sf):
    l = v_line(spark, sf)
    return J.blank_fields(l, S.length_between("sentence", 30, 45), ["doc_id", "pos"])


@query(
    "up08_upsert",
    """with deck as (select o_orderkey, o_orderpriority from orders where o_orderdate < timestamp '1999-01-01'),
            inc as (select o_orderkey, o_orderpriority || '*' as o_orderpriority from orders where o_orderstatus = 'F')
       select coalesce(d.o_orderkey, i.o_orderkey) as o_orderkey,
              case when i.o_orderkey is not null then i.o_orderpriority else d.o_orderpriority end as o_orderpriority
       from deck d full join inc i on d.o_orderkey = i.o_orderkey""",
)
def up08(spark, sf):
    o = table(spark, sf, "orders")
    deck = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")).select("o_orderkey", "o_orderpriority")
    inc = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", F.concat("o_orderpriority", F.lit("*")).alias("o_orderpriority"))
    return J.upsert(deck, inc, "o_orderkey")


@query(
    "up10_suppress",
    "select doc_id, case when source not in ('src0', 'src1') then source end as source from documents",
)
def up10(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return J.suppress(d, "source", ["src0", "src1"], "source")


# ---------------------------------------------------------------- JN ------

@query(
    "jn01_left_join",
    "select c.c_custkey, c.c_name, n.n_name from customer c left join nation n on c.c_nationkey = n.n_nationkey",
)
def jn01(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("k"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return J.left_join(c, n, "k").drop("k")


@query(
    "jn02_left_join_two_keys",
    """select l.l_orderkey, l.l_linenumber, l.l_quantity, r.l_quantity as l_quantity_r
       from (select distinct l_orderkey, l_linenumber, l_quantity from lineitem where l_returnflag = 'A') l
       left join (select l_orderkey, l_linenumber, max(l_quantity) as l_quantity from lineitem where l_returnflag = 'N' group by 1, 2) r
       on l.l_orderkey = r.l_orderkey and l.l_linenumber = r.l_linenumber""",
)
def jn02(spark, sf):
    li = table(spark, sf, "lineitem")
    a = li.where(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_quantity").distinct()
    b = li.where(F.col("l_returnflag") == "N").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    return J.left_join(a, b, ["l_orderkey", "l_linenumber"], "_r")


@query(
    "jn03_lookup",
    "select o.o_orderkey, c.c_name, c.c_mktsegment from orders o left join customer c on o.o_custkey = c.c_custkey",
)
def jn03(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer")
    # the customer dictionary is broadcast only if it provably has <= 1M rows
    return J.lookup(o, "o_custkey", c, "c_custkey", ["c_name", "c_mktsegment"]).drop("o_custkey")


@query(
    "jn04_match_in_deck",
    "select p.p_partkey, p.p_name, l.l_orderkey, l.l_linenumber from part p join lineitem l on p.p_partkey = l.l_partkey",
)
def jn04(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber")
    return J.match_in_deck(p, li, "p_partkey")


@query(
    "jn05_outer_on_index",
    """select coalesce(l.doc_id, d.doc_id) as doc_id, l.quality, d.lang
       from labels l full join documents d on l.doc_id = d.doc_id""",
)
def jn05(spark, sf):
    return J.outer_on_index(table(spark, sf, "labels").select("doc_id", "quality"), table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")


@query(
    "jn07_semi",
    "select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_returnflag = 'R')",
)
def jn07(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("p_partkey"))
    return J.semi(table(spark, sf, "part").select("p_partkey", "p_name"), li, "p_partkey")


@query(
    "jn08_anti",
    "select c_custkey, c_name from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT')",
)
def jn08(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti(table(spark, sf, "customer").select("c_custkey", "c_name"), o, "c_custkey", null_safe=True)


@query(
    "jn09_zip_rows",
    """select c.pos, c.c_name, s.s_name from
       (select row_number() over (order by c_custkey) as pos, c_name from customer) c
       join (select row_number() over (order by s_suppkey) as pos, s_name from supplier) s on c.pos = s.pos""",
)
def jn09(spark, sf):
    c = W.number_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), [], ["c_custkey"], "pos").drop("c_custkey")
    s = W.number_rows(table(spark, sf, "supplier").select("s_suppkey", "s_name"), [], ["s_suppkey"], "pos").drop("s_suppkey")
    return J.zip_rows(c, s, "pos", "inner")


@query(
    "jn12_is_known",
    f"""select t.doc_id, t.pos, t.i, t.token, k.w is not null as known
       from {V_TOK_SQL} t left join (
         select distinct w from (
           select unnest(string_split(text, ' ')) as w from benchmark
           union all select unnest(string_split(p_name, ' ')) as w from part)) k
       on t.token = k.w""",
)
def jn12(spark, sf):
    t = v_tok(spark, sf)
    b = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    p = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("w"))
    return J.is_known(t, "token", [b, p], "w", "known")


@query(
    "jn14_times_table",
    "select cast(p_size as bigint) as a, cast(b as bigint) as b, cast(p_size * b as bigint) as c from part, range(1, 11) t(b)",
)
def jn14(spark, sf):
    return J.times_table(table(spark, sf, "part"), "p_size", 1, 10)


@query(
    "jn15_language_pairs",
    """with l as (select distinct lang from documents),
            p as (select a.lang as a, b.lang as b from l a join l b on a.lang < b.lang),
            s as (select distinct lang, source from documents)
       select p.a, p.b, cast(count(*) as bigint) as shared_sources
       from p join s sa on sa.lang = p.a join s sb on sb.lang = p.b and sb.source = sa.source
       group by p.a, p.b""",
)
def jn15(spark, sf):
    d = table(spark, sf, "documents")
    s = d.select("lang", "source").distinct()
    sa = s.select(F.col("lang").alias("a"), F.col("source"))
    sb = s.select(F.col("lang").alias("b"), F.col("source"))
    return sa.join(sb, "source").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).cast("bigint").alias("shared_sources"))


@query(
    "jn16_article_of",
    """select l_orderkey, l_linenumber,
              case lower(l_linestatus) when 'f' then 'die' when 'm' then 'der' when 'n' then 'das' end as article
       from lineitem""",
)
def jn16(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", A.article_of(F.lower("l_linestatus")).alias("article"))


@query(
    "jn17_deck_titles",
    """with m as (select lang, cast(count(*) as varchar) as n_docs, cast(sum(n_chars) as varchar) as n_chars from documents group by lang),
            u as (select lang, 'n_docs' as label, n_docs as value from m union all select lang, 'n_chars', n_chars from m),
            l as (select distinct lang from documents),
            p as (select a.lang as a, b.lang as b from l a join l b on a.lang < b.lang)
       select p.a, p.b, ua.label, ua.value || ' - ' || ub.value as title
       from p join u ua on ua.lang = p.a join u ub on ub.lang = p.b and ub.label = ua.label""",
)
def jn17(spark, sf):
    d = table(spark, sf, "documents")
    m = d.groupBy("lang").agg(F.count(F.lit(1)).cast("string").alias("n_docs"), F.sum("n_chars").cast("string").alias("n_chars"))
    u = J.unpivot_matrix(m, "lang", ["n_docs", "n_chars"], "label", "value")
    langs = u.select("lang", "label")
    pairs = langs.withColumnRenamed("lang", "a").join(langs.withColumnRenamed("lang", "b"), "label").where("a < b").select("a", "b").distinct()
    return J.deck_titles(pairs, u, "lang", "label", "value")


@query(
    "jn18_pivot_pair",
    f"""select a.doc_id, a.pos, a.sentence as from_text, lower(b.sentence) as to_text
       from {V_LINE_SQL} a join {V_LINE_SQL} b on a.doc_id = b.doc_id and a.pos = b.pos""",
)
def jn18(spark, sf):
    l = v_line(spark, sf)
    both = l.select("doc_id", "pos", F.lit("de").alias("lang"), "sentence").union(l.select("doc_id", "pos", F.lit("en"), F.lower("sentence")))
    return J.pivot_pair(both, ["doc_id", "pos"], "lang", "sentence", "de", "en")


# --------------------------------------------------------------- AGG ------

AGG01_SQL = f"select token as word, cast(count(*) as bigint) as count from {V_TOK_SQL} group by token"


@query("agg01_word_counts", AGG01_SQL)
def agg01(spark, sf):
    return G.word_counts(v_line(spark, sf), "sentence", " ")


@query("agg02_distinct_in_order", "select source, min(doc_id) as first_seen from documents group by source")
def agg02(spark, sf):
    return G.distinct_in_order(table(spark, sf, "documents"), "source", "doc_id")


LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(
    "agg03_first_per_key",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity from (
          select *, row_number() over (partition by l_orderkey order by {', '.join(LI_ORDER)}) as rn from lineitem) where rn = 1""",
)
def agg03(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", *LI_ORDER)
    return G.first_per_key(li, "l_orderkey", LI_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "agg04_first_per_value",
    "select text_hash, min(doc_id) as doc_id from (select md5(text) as text_hash, doc_id from documents) group by text_hash",
)
def agg04(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_hash"))
    return G.first_per_key(d, "text_hash", ["doc_id"]).select("text_hash", "doc_id")


@query(
    "agg05_first_per_expr",
    f"""select doc_id, pos, i, token from (
          select *, row_number() over (partition by {_base_form_sql('token')} order by doc_id, pos, i) as rn from {V_TOK_SQL}) where rn = 1""",
)
def agg05(spark, sf):
    t = v_tok(spark, sf)
    return G.first_per_expr(t, S.base_form("token"), ["doc_id", "pos", "i"])


@query("agg06_distinct_rows", "select distinct l_orderkey, l_linenumber from lineitem")
def agg06(spark, sf):
    return G.distinct_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "agg07_collect_distinct_wide",
    """with cells as (
         select l_partkey, l_orderkey * 10 + l_linenumber as o, 0 as j, l_returnflag as v from lineitem
         union all select l_partkey, l_orderkey * 10 + l_linenumber, 1, l_linestatus from lineitem),
       firsts as (select l_partkey, v, min(o) as o from cells where v is not null group by l_partkey, v),
       firsts2 as (select f.l_partkey, f.v, f.o, min(c.j) as j from firsts f join cells c
                   on c.l_partkey = f.l_partkey and c.v = f.v and c.o = f.o group by f.l_partkey, f.v, f.o)
       select l_partkey, string_agg(v, ';' order by o, j, v) as "values" from firsts2 group by l_partkey""",
)
def agg07(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return G.collect_distinct_wide(li, "l_partkey", ["l_returnflag", "l_linestatus"], "o")


@query(
    "agg09_duplicates",
    """select l_orderkey, l_linenumber, l_partkey from lineitem where (l_orderkey, l_linenumber) in (
         select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
def agg09(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return G.duplicates(li, ["l_orderkey", "l_linenumber"])


@query(
    "agg10_block_chars",
    f"select doc_id, cast(sum(length(sentence) + 1) as bigint) as chars from {V_LINE_SQL} group by doc_id",
)
def agg10(spark, sf):
    return G.block_chars(v_line(spark, sf), "doc_id", "sentence")


@query(
    "agg11_rare_tokens",
    f"""with t as {V_TOK_SQL}, c as (select token as word, count(*) as cnt from t group by token),
            tg as (select doc_id, pos, token as target from t where i = 1)
       select t.doc_id, t.pos, cast(count(*) filter (where t.token <> tg.target and c.cnt <= 3) as bigint) as rare
       from t join tg on t.doc_id = tg.doc_id and t.pos = tg.pos left join c on t.token = c.word
       group by t.doc_id, t.pos""",
)
def agg11(spark, sf):
    l = v_line(spark, sf)
    counts = G.word_counts(l, "sentence", " ")
    # the target (first token) comes from the same line, so no join back
    # substring_index stays cheap even where the optimizer re-evaluates it per token
    t = l.select("doc_id", "pos", F.substring_index("sentence", " ", 1).alias("target"), F.explode(F.split("sentence", " ")).alias("token"))
    return G.rare_tokens(t, counts, l, ["doc_id", "pos"], "token", "target", 3)


@query(
    "agg12_block_mismatch",
    """with a as (select conv_id, count(*) as n_a from conversations where role = 'user' group by conv_id),
            b as (select conv_id, count(*) as n_b from conversations where role = 'assistant' group by conv_id)
       select coalesce(a.conv_id, b.conv_id) as conv_id, coalesce(a.n_a, 0) as n_a, coalesce(b.n_b, 0) as n_b
       from a full join b on a.conv_id = b.conv_id where coalesce(a.n_a, 0) <> coalesce(b.n_b, 0)""",
)
def agg12(spark, sf):
    c = table(spark, sf, "conversations")
    return G.block_mismatch(c.where(F.col("role") == "user"), c.where(F.col("role") == "assistant"), "conv_id")


@query(
    "agg13_last_per_key",
    """select user_id, event_id, event_type from (
         select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""",
)
def agg13(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return G.last_per_key(e, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "agg14_too_frequent",
    f"""select word, count, row_number() over (order by count desc, word) as rank
       from ({AGG01_SQL}) where count >= 11""",
)
def agg14(spark, sf):
    counts = G.word_counts(v_line(spark, sf), "sentence", " ")
    return G.too_frequent(counts, 11)


STATUS_SQL = "case event_type when 'purchase' then 'succeeded' when 'error' then 'failed' when 'click' then 'rate_limited' else 'other' end"


@query(
    "agg15_run_status",
    f"""select cast(count(*) as bigint) as started,
              cast(count(*) filter (where s = 'succeeded') as bigint) as succeeded,
              cast(count(*) filter (where s = 'failed') as bigint) as failed,
              cast(count(*) filter (where s = 'rate_limited') as bigint) as rate_limited,
              cast(count(*) filter (where s not in ('succeeded', 'failed', 'rate_limited')) as bigint) as other
       from (select {STATUS_SQL} as s from events)""",
)
def agg15(spark, sf):
    e = table(spark, sf, "events")
    s = F.when(F.col("event_type") == "purchase", "succeeded").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "rate_limited").otherwise("other")
    return G.run_status(e.select(s.alias("status")), "status")


@query(
    "agg16_request_cost",
    """select conv_id, cast(sum(len(string_split(text, ' ')) + 4) + 2 + 15 as bigint) as cost
       from conversations group by conv_id""",
)
def agg16(spark, sf):
    c = table(spark, sf, "conversations").withColumn("tokens", F.size(F.split("text", " ")))
    return G.request_cost(c, "conv_id", "tokens")


@query("agg17_n_rows", "select cast(count(*) as bigint) as n_rows from labels")
def agg17(spark, sf):
    return G.n_rows(table(spark, sf, "labels"))


@query("agg18_story_sizes", f"select doc_id, cast(count(*) as bigint) as n_sentences from {V_LINE_SQL} group by doc_id")
def agg18(spark, sf):
    return G.story_sizes(v_line(spark, sf), "doc_id")


@query(
    "agg19_source_words",
    """select doc_id, cast(u.i as bigint) as i, u.word from documents,
       lateral (select unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) as i) u""",
)
def agg19(spark, sf):
    return G.source_words(table(spark, sf, "documents"), "doc_id", "text", " ")


# ---------------------------------------------------------------- SE ------

@query(
    "se01_union_decks",
    """select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
       union all select s_suppkey, s_name, s_acctbal, null from supplier""",
)
def se01(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return J.union_decks(c, s)


@query(
    "se02_not_loaded",
    """select o_orderkey, o_orderstatus from orders where o_orderkey in (
         select o_orderkey from orders except select l_orderkey from lineitem)""",
)
def se02(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    loaded = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.not_loaded(o, loaded, "o_orderkey")


@query("se03_todo", "select doc_id from documents except select doc_id from labels")
def se03(spark, sf):
    return J.anti(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), "doc_id").distinct()


@query("se04_common_keys", "select p_partkey from part intersect select l_partkey from lineitem")
def se04(spark, sf):
    return table(spark, sf, "part").select("p_partkey").intersect(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey")))


@query(
    "se05_retry_round",
    """select distinct user_id, cast(ts as date) as day from events where event_type = 'error'
       except select user_id, cast(ts as date) from events where event_type = 'purchase'""",
)
def se05(spark, sf):
    e = table(spark, sf, "events")
    day = F.to_date("ts").alias("day")
    remaining = e.where(F.col("event_type") == "error").select("user_id", day).distinct()
    ok = e.where(F.col("event_type") == "purchase").select("user_id", day)
    return J.anti(remaining, ok, ["user_id", "day"])


@query(
    "se05_retry_until_done",
    """select user_id, cast(ts as date) as day, cast(count(*) - 1 as integer) as round from events where event_type = 'error' group by all""",
)
def se05r(spark, sf):
    """A user's day is tried until a round's number reaches its errors less
    one; each round leaves the days that failed."""
    from ..streaming.incremental import retry_rounds

    days = table(spark, sf, "events").where(F.col("event_type") == "error").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    done, left = retry_rounds(days, lambda rows, r: rows.withColumn("ok", F.col("n") <= r + 1))
    return done.unionByName(left.withColumn("round", F.lit(None).cast("int"))).select("user_id", "day", "round")


@query(
    "se05_retry_rounds",
    """select user_id, cast(ts as date) as day, case when count(*) <= 2 then cast(count(*) - 1 as integer) end as round
       from events where event_type = 'error' group by all""",
)
def se05l(spark, sf):
    """Two rounds only: what has failed in both remains, without a round."""
    from ..streaming.incremental import retry_rounds

    days = table(spark, sf, "events").where(F.col("event_type") == "error").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    done, left = retry_rounds(days, lambda rows, r: rows.withColumn("ok", F.col("n") <= r + 1), rounds=2)
    return done.unionByName(left.withColumn("round", F.lit(None).cast("int"))).select("user_id", "day", "round")


@query(
    "se06_split",
    "select o_orderkey, coalesce(o_totalprice > 100000, false) as expensive from orders",
)
def se06(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hi, lo = J.split(o, F.col("o_totalprice") > 100000)
    return hi.select("o_orderkey", F.lit(True).alias("expensive")).unionByName(lo.select("o_orderkey", F.lit(False).alias("expensive")))


@query(
    "se07_distinct_urls",
    "select distinct regexp_extract(url, '^https?://([^/]+)', 1) as host from pages where trim(regexp_extract(url, '^https?://([^/]+)', 1)) <> ''",
)
def se07(spark, sf):
    p = table(spark, sf, "pages").select(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))
    return J.distinct_non_blank(p, "host")


@query(
    "se08_merge_decks",
    f"""select token, doc_id, pos, i from (
          select t.*, row_number() over (partition by token order by doc_id, pos, i) as rn
          from {V_TOK_SQL} t) where rn = 1""",
)
def se08(spark, sf):
    """The decks of all languages, documents without one included, as one.
    A language's deck has a row per word; all decks come from one pass."""
    langs = table(spark, sf, "documents").select("doc_id", "lang")
    words = v_tok(spark, sf).join(langs, "doc_id")
    decks = cut_lineage(G.first_per_key(words, ["lang", "token"], ["doc_id", "pos", "i"]), "decks")
    # one deck per language that occurs: a handful of names
    names = [r[0] for r in decks.select("lang").distinct().collect()]
    merged = J.merge_decks([decks.where(F.col("lang").eqNullSafe(F.lit(n))) for n in names], "token", ["doc_id", "pos", "i"]) if names else decks
    return merged.select("token", "doc_id", "pos", "i")
