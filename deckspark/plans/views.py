"""Shared views over the driver tables, used by queries and tests.

``V_line``  documents split on newline: (doc_id, pos, sentence), pos from 1
``V_tok``   V_line split on one space: (doc_id, pos, i, token), i from 1
``V_note``  a deck of notes with a fractional index built from orders (roots)
            and lineitem (children: +0.001*linenumber, or +0.0001*linenumber
            for returned items, which play the user-added words)
``V_trans`` part names split on space: several translations per part
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import IDX_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as its files split it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "sentence")).select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "sentence"
    )


def v_line_idx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_line`` with a unique deck index: the line's number in the order
    (doc_id, pos), whatever the lengths of the texts."""
    from ..operators.window import number_rows

    return number_rows(v_line(spark, sf_dir), [], ["doc_id", "pos"], "idx").withColumn("idx", F.col("idx").cast(IDX_SQL))


def v_tok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_line(spark, sf_dir).select(
        "doc_id", "pos", F.posexplode(F.split("sentence", " ")).alias("i", "token")
    ).select("doc_id", "pos", (F.col("i") + 1).cast("bigint").alias("i"), "token")


def v_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    roots = orders.select(
        F.col("o_orderkey").cast(IDX_SQL).alias("idx"),
        F.col("o_orderstatus").alias("word"),
        F.col("o_orderpriority").alias("translation"),
        F.col("o_custkey").cast("bigint").alias("rank"),
    )
    step = F.when(F.col("l_returnflag") == "R", F.lit(0.0001)).otherwise(F.lit(0.001)).cast(IDX_SQL)
    children = lineitem.select(
        (F.col("l_orderkey").cast(IDX_SQL) + F.col("l_linenumber").cast(IDX_SQL) * step).cast(IDX_SQL).alias("idx"),
        F.col("l_linestatus").alias("word"),
        F.col("l_returnflag").alias("translation"),
        F.col("l_partkey").cast("bigint").alias("rank"),
    )
    return roots.unionByName(children)


V_NOTE_SQL = f"""(
  select cast(o_orderkey as {IDX_SQL}) as idx, o_orderstatus as word,
         o_orderpriority as translation, cast(o_custkey as bigint) as rank
  from orders
  union all
  select cast(cast(l_orderkey as {IDX_SQL}) + cast(l_linenumber as {IDX_SQL})
              * cast(case when l_returnflag = 'R' then 0.0001 else 0.001 end as {IDX_SQL}) as {IDX_SQL}) as idx,
         l_linestatus as word, l_returnflag as translation, cast(l_partkey as bigint) as rank
  from lineitem
)"""

V_LINE_SQL = """(
  select doc_id, cast(u.pos as bigint) as pos, u.sentence
  from documents,
       lateral (select unnest(string_split(text, chr(10))) as sentence,
                       generate_subscripts(string_split(text, chr(10)), 1) as pos) u
)"""

V_TOK_SQL = f"""(
  select l.doc_id, l.pos, cast(t.i as bigint) as i, t.token
  from {V_LINE_SQL} l,
       lateral (select unnest(string_split(l.sentence, ' ')) as token,
                       generate_subscripts(string_split(l.sentence, ' '), 1) as i) t
)"""


def v_trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "translation")
    ).select("p_partkey", (F.col("i") + 1).cast("bigint").alias("i"), "translation")


def rare_sql(deck: str, out: str, max_occ: int = 3, min_rare: int = 2) -> str:
    """The rare-word filter over ``deck`` (r, target, lemmas): row r is the
    r-th from below.  ``walk`` goes round by round (r, state: 0 rejected, 1
    accepted, 2 open) until no row is open."""
    return f"""with recursive deck as materialized ({deck}),
            occ as (select r, t, coalesce(t = target, false) as own, count(*) as n
                    from (select r, target, unnest(string_split(lemmas, ';')) as t from deck where lemmas is not null) group by all),
            o as materialized (select occ.*, sum(n) over (partition by t) as total from occ),
            walk as (
              select r, 2 as state from deck where lemmas is not null
              union all
              select w.r, case when w.state <> 2 then w.state when not s.own then 0 when s.sure >= {min_rare} then 1 when s.hope < {min_rare} then 0 else 2 end
              from walk w join (
                select r, bool_or(own) as own, coalesce(sum(n) filter (where not own and total - gone <= {max_occ}), 0) as sure,
                       coalesce(sum(n) filter (where not own and total - gone - pending <= {max_occ}), 0) as hope
                from (select o.*, coalesce(sum(case when x.state = 0 then o.n end) over above, 0) as gone,
                             coalesce(sum(case when x.state = 2 then o.n end) over above, 0) as pending
                      from o join walk x on x.r = o.r
                      window above as (partition by o.t order by -o.r range between unbounded preceding and 1 preceding))
                group by r) s on s.r = w.r
              where exists (select 1 from walk where state = 2)),
            decided as (select distinct r, state = 1 as accepted from walk where state <> 2)
       {out}"""
