"""Queries for the fractional index, deck ordering, windows and checks
(MTH, FL-07..09/14, OR, WN, JN-06/10/11/13, DQ)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import index as ix
from ..functions import text as S
from ..operators import agg as G
from ..operators import checks as C
from ..operators import joins as J
from ..operators import window as W
from ..operators.scan import interval_join
from ..operators.columns import group_rank
from .catalog import query
from .q_core import _base_form_sql, strip_sql
from .views import V_LINE_SQL, V_NOTE_SQL, rare_sql, table, v_line, v_line_idx, v_note, v_trans

D = "decimal(18,6)"
NOTE_ORDER = ["word", "translation", "rank"]
FRAC_SQL = f"cast(idx - floor(idx) as {D})"
LZ_SQL = f"(case when {FRAC_SQL} = 0 then -1 else length(regexp_extract(cast({FRAC_SQL} as varchar), '\\.(0*)', 1)) end)"


# --------------------------------------------------------------- MTH ------

@query("mth01_frac_root", f"select idx, cast(floor(idx) as bigint) as root, {FRAC_SQL} as frac from {V_NOTE_SQL}")
def mth01(spark, sf):
    n = v_note(spark, sf)
    return n.select("idx", ix.root("idx").alias("root"), ix.frac("idx").alias("frac"))


@query("mth02_round", f"select idx, cast(round(idx, 2) as {D}) as idx2, cast(round(idx, 3) as {D}) as idx3 from {V_NOTE_SQL}")
def mth02(spark, sf):
    n = v_note(spark, sf)
    return n.select("idx", ix.round_idx("idx", 2).alias("idx2"), ix.round_idx("idx", 3).alias("idx3"))


@query(
    "mth03_ceil_div",
    "select o_orderkey, cast(ceil(o_custkey / 70) as bigint) as blocks, least(cast(ceil(o_custkey / 70) as bigint), 20) as capped from orders",
)
def mth03(spark, sf):
    o = table(spark, sf, "orders")
    b = ix.ceil_div(F.col("o_custkey"), F.lit(70))
    return o.select("o_orderkey", b.alias("blocks"), F.least(b, F.lit(20).cast("bigint")).alias("capped"))


@query("mth04_leading_zeros", f"select idx, cast({LZ_SQL} as integer) as leading_zeros from {V_NOTE_SQL}")
def mth04(spark, sf):
    n = v_note(spark, sf)
    return n.select("idx", ix.leading_zeros("idx").alias("leading_zeros"))


@query(
    "mth05_product_facts",
    """select l_orderkey, l_linenumber, cast(l_linenumber as bigint) as a, cast(l_quantity as bigint) as b,
              cast(l_linenumber * cast(l_quantity as bigint) as bigint) as c,
              cast((l_linenumber * cast(l_quantity as bigint)) // l_linenumber as bigint) as quotient
       from lineitem""",
)
def mth05(spark, sf):
    li = table(spark, sf, "lineitem")
    a = F.col("l_linenumber").cast("bigint")
    b = F.col("l_quantity").cast("bigint")
    return li.select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"), (a * b).alias("c"), F.floor((a * b) / a).cast("bigint").alias("quotient"))


# ------------------------------------------------------------ FL idx ------

@query("fl07_is_root", f"select idx, word from {V_NOTE_SQL} where idx = floor(idx)")
def fl07(spark, sf):
    return v_note(spark, sf).where(ix.is_root("idx")).select("idx", "word")


@query(
    "fl08_is_custom_note",
    f"select idx, word from {V_NOTE_SQL} where round({FRAC_SQL}, 4) >= 0.0001 and round({FRAC_SQL}, 4) < 0.001",
)
def fl08(spark, sf):
    return v_note(spark, sf).where(ix.is_custom_note("idx")).select("idx", "word")


@query("fl09_block_of", f"select cast(floor(idx) as bigint) as block, cast(count(*) as bigint) as n from {V_NOTE_SQL} group by 1")
def fl09(spark, sf):
    return v_note(spark, sf).groupBy(ix.block_of("idx").alias("block")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query(
    "fl14_exclude_blocks",
    f"select idx, word from {V_NOTE_SQL} where cast(floor(idx) as bigint) not in (select o_orderkey from orders where o_orderstatus = 'P')",
)
def fl14(spark, sf):
    skip = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("__b"))
    return C.exclude_blocks(v_note(spark, sf), skip, "__b").select("idx", "word")


# ---------------------------------------------------------------- OR ------

def _numbered_sql(order: str, src: str, cols: str, out: str = "pos") -> str:
    return f"select {cols}, row_number() over (order by {order}) as {out} from {src}"


@query("or01_sort_index", _numbered_sql("idx, word, translation, rank", V_NOTE_SQL, "idx, word"))
def or01(spark, sf):
    return W.number_rows(v_note(spark, sf), [], ["idx", *NOTE_ORDER], "pos").select("idx", "word", "pos")


@query(
    "or02_deck_order",
    _numbered_sql(f"floor(idx), {LZ_SQL}, {FRAC_SQL}, word, translation, rank", V_NOTE_SQL, "idx, word"),
)
def or02(spark, sf):
    n = v_note(spark, sf).withColumn("__r", ix.root("idx"))
    key = [F.col("__r"), ix.leading_zeros("idx"), ix.frac("idx"), *NOTE_ORDER]
    return W.number_rows(n, [], key, "pos").select("idx", "word", "pos")


DOC_LABEL_SQL = "(select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id)"


def _doc_labels(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("or03_complete_first", _numbered_sql("quality is null, doc_id", DOC_LABEL_SQL, "doc_id, quality"))
def or03(spark, sf):
    x = _doc_labels(spark, sf).withColumn("__g", F.col("quality").isNull().cast("int"))
    return W.number_rows(x, [], ["__g", "doc_id"], "pos").drop("__g")


@query(
    "or04_group_order",
    _numbered_sql("case when quality = 1 then 0 when quality is not null then 1 else 2 end, doc_id", DOC_LABEL_SQL, "doc_id, quality"),
)
def or04(spark, sf):
    g = group_rank([F.col("quality") == 1, F.col("quality").isNotNull()])
    x = _doc_labels(spark, sf).withColumn("__g", g)
    return W.number_rows(x, [], ["__g", "doc_id"], "pos").drop("__g")


@query(
    "or05_top_words",
    f"""select word, count, row_number() over (order by count desc, word) as rank from (
          select token as word, cast(count(*) as bigint) as count from (
            select unnest(string_split(sentence, ' ')) as token from {V_LINE_SQL}) group by token)""",
)
def or05(spark, sf):
    counts = G.word_counts(v_line(spark, sf), "sentence", " ")
    return G.rank_words(counts)


@query(
    "or06_sample_rows",
    "select o_orderkey, o_totalprice from orders order by md5(cast(o_orderkey as varchar) || ':42'), o_orderkey limit 70",
)
def or06(spark, sf):
    from ..operators.order import sample_rows

    return sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 70, seed=42)


@query("or07_preview", "select p_partkey, p_name from part order by p_partkey limit 5")
def or07(spark, sf):
    from ..operators.order import preview

    return preview(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], 5)


@query(
    "or08_order_numeric",
    "select c_custkey, row_number() over (order by cast(split_part(c_name, '#', 2) as bigint), c_custkey) as pos from customer",
)
def or08(spark, sf):
    c = table(spark, sf, "customer").withColumn("__n", F.split_part("c_name", F.lit("#"), F.lit(2)).cast("bigint"))
    return W.number_rows(c, [], ["__n", "c_custkey"], "pos").select("c_custkey", "pos")


@query("or09_reverse_index", _numbered_sql("idx desc, word desc, translation desc, rank desc", V_NOTE_SQL, "idx, word"))
def or09(spark, sf):
    n = v_note(spark, sf)
    order = [F.col("idx").desc(), F.col("word").desc(), F.col("translation").desc(), F.col("rank").desc()]
    return W.number_rows(n, [], order, "pos").select("idx", "word", "pos")


@query("or10_by_length", _numbered_sql("length(sentence), doc_id, pos", V_LINE_SQL, "doc_id, pos", "rank"))
def or10(spark, sf):
    l = v_line(spark, sf).withColumn("__len", F.char_length("sentence"))
    return W.number_rows(l, [], ["__len", "doc_id", "pos"], "rank").select("doc_id", "pos", "rank")


@query("or11_by_topic_word", _numbered_sql("c_mktsegment, c_name, c_custkey", "customer", "c_custkey"))
def or11(spark, sf):
    c = table(spark, sf, "customer")
    return W.number_rows(c, [], ["c_mktsegment", "c_name", "c_custkey"], "pos").select("c_custkey", "pos")


@query("or12_renumber", "select s_suppkey, row_number() over (order by s_name, s_suppkey) - 1 as pos from supplier")
def or12(spark, sf):
    s = table(spark, sf, "supplier")
    x = W.number_rows(s, [], ["s_name", "s_suppkey"], "pos")
    return x.select("s_suppkey", (F.col("pos") - 1).alias("pos"))


# ---------------------------------------------------------------- WN ------

@query(
    "wn01_suffix_occurrences",
    f"""select p_partkey, i, translation,
              cast(cast(p_partkey as {D}) + cast(row_number() over (partition by p_partkey order by i) - 1 as {D}) * cast(0.001 as {D}) as {D}) as idx
       from (select p_partkey, cast(u.i as bigint) as i, u.translation from part,
             lateral (select unnest(string_split(p_name, ' ')) as translation, generate_subscripts(string_split(p_name, ' '), 1) as i) u)""",
)
def wn01(spark, sf):
    t = v_trans(spark, sf).withColumn("idx", F.col("p_partkey").cast(D))
    return W.suffix_occurrences(t, "idx", ["i"], "0.001")


@query(
    "wn02_with_context",
    """select conv_id, turn, coalesce(lag(text) over w, '') as text_prev, coalesce(lead(text) over w, '') as text_next
       from conversations window w as (partition by conv_id order by turn)""",
)
def wn02(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return W.with_context(c, "conv_id", "turn", ["text"]).drop("text")


DOC_SIZES_SQL = f"(select doc_id, count(*) as n from {V_LINE_SQL} group by doc_id)"


@query(
    "wn03_line_offsets",
    f"""select doc_id, cast(coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as start_line,
              cast(sum(n) over (order by doc_id rows between unbounded preceding and current row) as bigint) as end_line
       from {DOC_SIZES_SQL}""",
)
def wn03(spark, sf):
    sizes = G.story_sizes(v_line(spark, sf), "doc_id").withColumnRenamed("n_sentences", "n")
    return W.line_offsets(sizes, "doc_id", "n").select("doc_id", "start_line", F.col("end_line").cast("bigint"))


@query(
    "wn04_number_rows",
    f"""select doc_id, pos, case when length(cast(rn as varchar)) >= 5 then cast(rn as varchar) else lpad(cast(rn as varchar), 5, '0') end as sentence_id
       from (select doc_id, pos, row_number() over (order by doc_id, pos) as rn from {V_LINE_SQL})""",
)
def wn04(spark, sf):
    x = W.number_rows(v_line(spark, sf), [], ["doc_id", "pos"], "__rn")
    return x.select("doc_id", "pos", S.pad("__rn", 5).alias("sentence_id"))


@query(
    "wn05_missing_meanings",
    f"""with deck as {V_NOTE_SQL},
            wanted as (select o_orderkey as block, f as translation from orders, (values ('A'), ('N'), ('R')) v(f)),
            have as (select cast(floor(idx) as bigint) as block, translation from deck),
            missing as (select distinct block, translation from wanted w where not exists
                        (select 1 from have h where h.block = w.block and h.translation = w.translation)),
            bmax as (select cast(floor(idx) as bigint) as block, max(idx) as block_max from deck group by 1)
       select m.block, m.translation, b.block_max,
              cast(b.block_max + cast(row_number() over (partition by m.block order by m.translation) as {D}) * cast(0.001 as {D}) as {D}) as new_idx,
              cast(b.block_max + cast(row_number() over (partition by m.block order by m.translation) as {D}) * cast(0.001 as {D}) as {D})
                - floor(b.block_max + cast(row_number() over (partition by m.block order by m.translation) as {D}) * cast(0.001 as {D})) >= 0.01 as overflow
       from missing m join bmax b on m.block = b.block""",
)
def wn05(spark, sf):
    deck = v_note(spark, sf)
    o = table(spark, sf, "orders")
    wanted = o.select(F.col("o_orderkey").alias("block"), F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("translation"))
    return W.missing_meanings(deck, wanted)


@query("wn06_positions", "select doc_id, pos, cast(length(sentence) as bigint) as len from " + V_LINE_SQL)
def wn06(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return W.positions(d, ["doc_id"], "lines", "pos", "sentence").select("doc_id", "pos", S.length("sentence").alias("len"))


def wn07_sql(limit: int, m: int) -> str:
    """The walk from block to block; the end of each by its prefix sums."""
    return f"""with recursive l as (select doc_id, pos, length({strip_sql('sentence')}) + 1 as c from {V_LINE_SQL}),
            d as (select distinct doc_id from l),
            padded as (select doc_id, 1 as s, pos as p, c from l
                       union all select doc_id, side, i, 1 from d, (values (0), (2)) t(side), range({m}) u(i)),
            upto as (select doc_id, row_number() over w as e, sum(c) over w as pre from padded
                     window w as (partition by doc_id order by s, p rows unbounded preceding)),
            size as (select doc_id, max(e) - {2 * m} as n from upto group by doc_id),
            asked as (select doc_id, 0 as s, {limit + m} as pre from size union all select doc_id, e, pre + {limit} from upto),
            hops as (select a.doc_id, a.s, greatest(a.s + {m}, u.e - {m + 2}) as k
                     from asked a asof join upto u on a.doc_id = u.doc_id and a.pre < u.pre),
            inside as (select hops.* from hops join size using (doc_id) where k <= n + {m}),
            walk as (select doc_id, cast(0 as bigint) as s, cast(0 as bigint) as block from size
                     union all select w.doc_id, h.k + 1 - {m}, w.block + 1 from walk w join inside h on w.doc_id = h.doc_id and w.s = h.s)
       select w.doc_id, w.block, w.s as start, cast(coalesce(h.k + {m}, z.n + {2 * m}) as bigint) as end
       from walk w join size z using (doc_id) left join inside h on w.doc_id = h.doc_id and w.s = h.s"""


@query("wn07_pack_blocks", wn07_sql(3000, 3))
def wn07(spark, sf):
    from ..operators.packing import pack_blocks

    lines = v_line(spark, sf)
    return pack_blocks(lines, "doc_id", "pos", "sentence", max_symbols=3000, margin=3)


@query(
    "wn07_block_lines",
    f"""with b as ({wn07_sql(3000, 3)}), k as (select doc_id, block, unnest(range(start, "end" + 1)) as k from b)
       select k.doc_id, k.block, k.k, coalesce({strip_sql('l.sentence')}, '') as sentence
       from k left join {V_LINE_SQL} l on l.doc_id = k.doc_id and l.pos = k.k - 2""",
)
def wn07l(spark, sf):
    """The lines that every block holds, margins included."""
    from ..operators.packing import block_lines, pack_blocks

    lines = v_line(spark, sf)
    return block_lines(pack_blocks(lines, "doc_id", "pos", "sentence"), lines, "doc_id", "pos", "sentence")


@query("wn07_pack_blocks_jumping", wn07_sql(500, 2))
def wn07j(spark, sf):
    """Every text by pointer doubling, as texts of any length are."""
    from ..operators.packing import pack_blocks

    return pack_blocks(v_line(spark, sf), "doc_id", "pos", "sentence", max_symbols=500, margin=2, fold_lines=0)


@query(
    "wn08_with_margins",
    f"""select doc_id, pos,
              coalesce(lag(sentence, 2) over w, '') || chr(10) || coalesce(lag(sentence, 1) over w, '') as before,
              coalesce(lead(sentence, 1) over w, '') || chr(10) || coalesce(lead(sentence, 2) over w, '') as after
       from {V_LINE_SQL} window w as (partition by doc_id order by pos)""",
)
def wn08(spark, sf):
    x = W.with_margins(v_line(spark, sf), "doc_id", "pos", "sentence", 2)
    return x.select("doc_id", "pos", F.array_join("before", "\n").alias("before"), F.array_join("after", "\n").alias("after"))


@query(
    "wn09_fixed_blocks",
    "select o_orderkey, cast(floor((row_number() over (order by o_orderkey) - 1) / 70) as bigint) as block from orders",
)
def wn09(spark, sf):
    return W.fixed_blocks(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 70)


@query(
    "wn10_round_robin",
    "select o_orderkey, cast((floor((row_number() over (order by o_orderkey) - 1) / 70)) % 10 as integer) as worker from orders",
)
def wn10(spark, sf):
    b = W.fixed_blocks(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 70)
    return W.assign_round_robin(b, "block", 10).select("o_orderkey", "worker")


@query(
    "wn11_filter_rare_sentences",
    rare_sql(
        f"""select r, cast(r as {D}) as idx, word, lemmas, {_base_form_sql('word')} as target from (
              select row_number() over (order by doc_id, pos) as r, split_part(sentence, ' ', 1) as word, replace(sentence, ' ', ';') as lemmas from {V_LINE_SQL})""",
        "select idx, word, lemmas, accepted from deck join decided using (r)",
    ),
)
def wn11(spark, sf):
    from ..operators.rare import filter_rare_sentences

    deck = _rare_deck(spark, sf)
    return filter_rare_sentences(deck, "idx", "word", "lemmas")


def _rare_deck(spark, sf):
    """Deck for the rare-word filter: one row per document line; the word is
    the line's first token, the lemmatised sentence its ';'-joined tokens."""
    return v_line_idx(spark, sf).select(
        "idx",
        F.split_part("sentence", F.lit(" "), F.lit(1)).alias("word"),
        F.array_join(F.split("sentence", " "), ";").alias("lemmas"),
    )


@query(
    "wn13_block_ranges",
    f"""select doc_id, '[ ' || cast(s as varchar) || ' ; ' || cast(least(s + n, 100000000) as varchar) || ' )' as block_range from (
          select doc_id, n, coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as s from {DOC_SIZES_SQL})""",
)
def wn13(spark, sf):
    sizes = G.story_sizes(v_line(spark, sf), "doc_id").withColumnRenamed("n_sentences", "n")
    r = W.block_ranges(sizes, "doc_id", "n")
    return r.select("doc_id", S.mkrange(F.col("start"), F.col("start") + F.col("n"), maxi=100000000).alias("block_range"))


# --------------------------------------------------------- JN on idx ------

LI_IDX_SQL = f"(select cast(cast(l_orderkey as {D}) + cast(l_linenumber as {D}) * cast(0.001 as {D}) as {D}) as idx, l_quantity from lineitem where l_returnflag <> 'R')"


@query(
    "jn06_left_on_index",
    f"select n.idx, n.word, l.l_quantity from {V_NOTE_SQL} n left join {LI_IDX_SQL} l on n.idx = l.idx",
)
def jn06(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") != "R").select(
        ix.suffix(F.col("l_orderkey").cast(D), F.col("l_linenumber"), "0.001").alias("idx"), "l_quantity"
    )
    return J.left_on_index(v_note(spark, sf).select("idx", "word"), li, "idx")


@query(
    "jn10_with_root",
    f"""select c.idx, c.word, r.word as word_root from {V_NOTE_SQL} c
        left join (select cast(floor(idx) as bigint) as b, word from {V_NOTE_SQL} where idx = floor(idx)) r
        on cast(floor(c.idx) as bigint) = r.b where c.idx <> floor(c.idx)""",
)
def jn10(spark, sf):
    n = v_note(spark, sf)
    children = n.where(~ix.is_root("idx")).select("idx", "word")
    return J.with_root(children, n.select("idx", "word"), "idx", ["word"], "_root")


@query(
    "jn11_join_block",
    f"""select n.idx, o.o_totalprice from {V_NOTE_SQL} n join orders o on cast(floor(n.idx) as bigint) = o.o_orderkey""",
)
def jn11(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast(D).alias("idx"), "o_totalprice")
    return J.join_block(v_note(spark, sf).select("idx"), o, "idx", "_b").select("idx", F.col("o_totalprice_b").alias("o_totalprice"))


@query(
    "jn11_interval_join",
    """select l_orderkey, l_linenumber, c_custkey from lineitem join customer
       on l_extendedprice >= c_acctbal and l_extendedprice < c_acctbal + 1""",
)
def jn11i(spark, sf):
    """Lines whose price lies within one unit above a customer's balance."""
    points = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    spans = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("lo"), (F.col("c_acctbal") + 1).alias("hi"))
    return interval_join(points, spans, "price", "lo", "hi").select("l_orderkey", "l_linenumber", "c_custkey")


@query(
    "jn13_attach_examples",
    """with rows as (select p_partkey as block, cast(u.i as bigint) as i, u.translation from part,
                     lateral (select unnest(string_split(p_name, ' ')) as translation, generate_subscripts(string_split(p_name, ' '), 1) as i) u),
            ex as (select l.l_partkey as block, split_part(p.p_name, ' ', 1) as translation,
                          'order ' || cast(l.l_orderkey as varchar) as sentence, l.l_orderkey, l.l_linenumber, l.l_suppkey
                   from lineitem l join part p on l.l_partkey = p.p_partkey),
            first_ex as (select block, translation, sentence from (
                          select *, row_number() over (partition by block, translation order by l_orderkey, l_linenumber, l_suppkey) as rn from ex) where rn = 1)
       select r.block, r.i, r.translation, f.sentence from rows r left join first_ex f on r.block = f.block and r.translation = f.translation""",
)
def jn13(spark, sf):
    from .deck_jobs import attach_examples

    rows = v_trans(spark, sf).withColumnRenamed("p_partkey", "block")
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    ex = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_partkey").alias("block"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("translation"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("sentence"),
        "l_orderkey", "l_linenumber", "l_suppkey",
    )
    return attach_examples(rows, ex, ["l_orderkey", "l_linenumber", "l_suppkey"]).select("block", "i", "translation", "sentence")


# ---------------------------------------------------------------- DQ ------

@query(
    "dq01_check_unique",
    f"select idx, cast(count(*) as bigint) as n from {V_NOTE_SQL} group by idx having count(*) > 1",
)
def dq01(spark, sf):
    return C.check_unique(v_note(spark, sf), "idx")


DQ02_IDX = f"cast(cast(l_orderkey as {D}) + cast(l_linenumber as {D}) * cast(0.002 as {D}) as {D})"


@query(
    "dq02_check_fraction",
    f"select idx from (select {DQ02_IDX} as idx from lineitem) where idx - floor(idx) >= 0.01",
)
def dq02(spark, sf):
    li = table(spark, sf, "lineitem").select(ix.suffix(F.col("l_orderkey").cast(D), F.col("l_linenumber"), "0.002").alias("idx"))
    return C.check_fraction(li, "idx", "0.01")


# a seventh of the words are missing, so that nulls are judged too
N_GAPS_SQL = f"(select idx, case when rank % 7 = 0 then null else word end as word from {V_NOTE_SQL})"


def _note_gaps(spark, sf):
    return v_note(spark, sf).select("idx", F.when(F.col("rank") % 7 != 0, F.col("word")).alias("word"))


@query(
    "dq03_check_same_word",
    f"""with n as {N_GAPS_SQL},
            r as (select cast(floor(idx) as bigint) as b, word as root_word from n where idx = floor(idx)),
            bad as (select n.idx, n.word from n join r on cast(floor(n.idx) as bigint) = r.b
                    where n.idx <> floor(n.idx) and (n.word is null or r.root_word is null or n.word <> r.root_word))
       select distinct idx, word from (
         select idx, word from bad
         union all select n.idx, n.word from n where n.idx = floor(n.idx)
                   and cast(floor(n.idx) as bigint) in (select cast(floor(idx) as bigint) from bad))""",
)
def dq03(spark, sf):
    return C.check_same_word(_note_gaps(spark, sf), "idx", "word")


@query(
    "dq04_check_verbs",
    """select p_partkey, p_name from part
       where p_type = 'PROMO' and (p_name is null or not starts_with(p_name, 'to ')) and p_size <= 45""",
)
def dq04(spark, sf):
    p = table(spark, sf, "part")
    skip = p.where(F.col("p_size") > 45).select(F.col("p_partkey").alias("__b"))
    x = p.select("p_partkey", "p_name", F.when(F.col("p_type") == "PROMO", "verb").otherwise("noun").alias("pos"))
    return C.check_verbs(x, "p_partkey", "p_name", "pos", skip, "__b").select("p_partkey", "p_name")


@query(
    "dq05_check_examples",
    f"""with n as {N_GAPS_SQL},
            r as (select cast(floor(idx) as bigint) as b, word as root_word from n where idx = floor(idx))
       select n.idx, n.word, r.root_word as word_actual from n join r on cast(floor(n.idx) as bigint) = r.b
       where n.idx <> floor(n.idx) and (n.word is null or r.root_word is null or n.word <> r.root_word)""",
)
def dq05(spark, sf):
    n = _note_gaps(spark, sf)
    return C.check_examples(n.where(~ix.is_root("idx")), n, "idx", "word")


@query(
    "dq06_diff_keys",
    """with a as (select o_orderkey from orders where o_orderdate < timestamp '1999-01-01'),
            b as (select o_orderkey from orders where o_orderstatus = 'F')
       select o_orderkey, 'only_a' as side from (select * from a except select * from b)
       union all select o_orderkey, 'only_b' from (select * from b except select * from a)""",
)
def dq06(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")).select("o_orderkey")
    b = o.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    return C.diff_keys(a, b, "o_orderkey")


@query(
    "dq07_check_block_lengths",
    f"""with a as (select doc_id, count(*) as n_a from {V_LINE_SQL} group by doc_id),
            b as (select doc_id, cast(len(string_split(text, '. ')) as bigint) as n_b from documents)
       select a.doc_id, a.n_a, b.n_b from a join b on a.doc_id = b.doc_id where a.n_a <> b.n_b""",
)
def dq07(spark, sf):
    a = v_line(spark, sf)
    sentences = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", r"\. ")).alias("s"))
    return C.check_block_lengths(a, sentences, "doc_id")


@query(
    "dq10_check_rendered",
    """select c_custkey, rendered from (
         select c_custkey, replace(replace('{{name}} in {{segment}} owes {{balance}}', '{{name}}', c_name), '{{segment}}', c_mktsegment) as rendered
         from customer) where regexp_matches(rendered, '\\{\\{[^}]*\\}\\}')""",
)
def dq10(spark, sf):
    from ..operators.cards import render_template

    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    r = render_template(c, "{{name}} in {{segment}} owes {{balance}}", ["name", "segment"], "rendered")
    return C.check_rendered(r, "rendered").select("c_custkey", "rendered")


@query("dq11_check_line_breaks", "select doc_id from documents where not contains(text, chr(10))")
def dq11(spark, sf):
    return C.check_line_breaks(table(spark, sf, "documents"), "text").select("doc_id")


@query(
    "dq12_check_pending",
    """select cast(count(*) as bigint) as n_pending, count(*) = 0 as nothing_left
       from documents d left join labels l on d.doc_id = l.doc_id where l.quality is null""",
)
def dq12(spark, sf):
    j = _doc_labels(spark, sf)
    return C.check_pending(j.where(F.col("quality").isNull()))


@query(
    "dq13_check_rank_order",
    """select p_partkey, p_size, prev_size from (
         select p_partkey, p_size, lag(p_size) over (order by p_partkey) as prev_size from part)
       where prev_size > p_size""",
)
def dq13(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return C.check_rank_order(p, "p_partkey", "p_size").select("p_partkey", "p_size", "prev_size")


@query(
    "dq13_consecutive_indices",
    """select o_orderkey, o_shippriority, prev_size, prev_index from (
         select o_orderkey, cast(o_custkey // 100 as bigint) as o_shippriority, lag(cast(o_custkey // 100 as bigint)) over w as prev_size, lag(o_orderkey) over w as prev_index
         from orders window w as (order by o_orderkey))
       where prev_size > o_shippriority or (prev_size = o_shippriority and o_orderkey - prev_index <> 1)""",
)
def dq13c(spark, sf):
    """Orders as cards, a hundred customers to a rank."""
    o = table(spark, sf, "orders").select("o_orderkey", F.floor(F.col("o_custkey") / 100).alias("o_shippriority"))
    return C.check_rank_order(o, "o_orderkey", "o_shippriority", consecutive=True)
