"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table and derives the contract's columns
from the operator's results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_documents, write_token_files

    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return read_documents(spark, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op3_bpe_automaton")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_automaton import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_simhash_gray")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_gray import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines_removed")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import held_out, predict, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(4, 2)))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import held_out
    from .toxicity import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~held_out(3, 1)
    model = train(docs.where(learn), table(spark, sf_dir, "labels").where(learn).select("doc_id", "toxic"))
    found = score(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score")
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    found = read_archives(spark, write_archives(table(spark, sf_dir, "pages")))
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    pages = found.where("record_type in ('response', 'revisit')")
    return pages.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


@query("op8_vector_graph")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import removed_digests

    return removed_digests(table(spark, sf_dir, "documents")).withColumn("repeated", F.col("n_removed") > 0)


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query("op11_url_model", SQL.url_model(URL_RULES, order=4))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_model import judge_urls, rule

    found = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), [rule(*r) for r in URL_RULES])
    return found.select("page_id", "host", "path", "rule", "verdict")


def rewritten(text: str = "text") -> F.Column:
    """The words of the text, numbered from 0; in a tenth of the documents
    (by crc32 of the id, h) those from a = g % n on repeat with period p."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def repeat(w):
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    own = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w))), 0)
    return F.when(F.pmod(h, F.lit(10)) == 0, own).otherwise(F.col(text))


@query("op12_periodic_runs", SQL.PERIODIC_RUNS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .runs import periodic_runs

    docs = table(spark, sf_dir, "documents").select("doc_id", rewritten().alias("text"))
    found = periodic_runs(docs)
    # runs come by start, then period: only a greater exponent replaces the first
    best = F.reduce("runs", F.get("runs", 0), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_hard_negatives", SQL.HARD_NEGATIVES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.pmod("vec_id", F.lit(100)) == 0)
