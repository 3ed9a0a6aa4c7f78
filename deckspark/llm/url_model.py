"""Operator 11: URL filter by a ratio of character language models.

Rules name hosts (with their subdomains) and path prefixes; the longest rule
that fits decides.  The URLs that rules accept and reject teach two smoothed
variable-order Markov models of characters: the probability of a character
after its last ``ORDER`` characters is interpolated (Witten and Bell) with
that after one character less, and so on down to a uniform distribution over
all code points, so a context counts as far as it was seen.  A URL that no
rule names is judged by the difference of its log-likelihoods under both
models per character.  The cut is calibrated on ruled URLs that the models
have not seen: the one with the least balanced error, ties to the one nearest
to zero.

All of it is Spark aggregates and joins.  Counts cover every row of the
table; no count, context or URL is dropped and no model is broadcast unless
the planner has measured it to be small.  Equal URLs are summed first, so a
URL that many rows share goes on as one row, and every distinct n-gram is
rated once.

Defined results: a null URL is read as the empty one, which like any other
is judged by its (single, end of text) symbol; with no rule or no scheme
mark, host and path are empty; without accepted or without rejected URLs to
learn from a model is uniform, and without both in the calibration fold the
cut is 0; repeated rows each count and each come back; very long URLs are
read whole, one row per character; an empty table gives no rows; other
columns pass through :func:`judge_urls`, where the columns it adds replace
those of the same name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut_lineage, spread

ORDER = 4  # characters of context
BIN = 0.001  # of the score, for calibration
MOST_BIN = 10_000  # scores beyond +-10 share the outer bins
CODE_POINTS = 0x110000
START, END = "\u0002", "\u0003"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """The rule of ``host/path``."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    mark = F.instr(url, "://")
    after = F.when(mark > 0, url.substr(mark + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after.substr(F.length(host) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def with_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (null
    where no rule fits).  Rules are a short list: they become one expression."""
    host, path = host_path(F.coalesce(F.col(url), F.lit("")))
    x = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = lambda r: ((F.col("host") == r.host) | F.endswith("host", F.lit(f".{r.host}"))) & F.startswith("path", F.lit(r.path))
    none = F.lit(None).cast("string")
    pick = lambda of: F.coalesce(*[F.when(fits(r), of(r)) for r in longest], none)
    return x.withColumns({"rule": pick(lambda r: r.text), "verdict": pick(lambda r: r.verdict)})


def in_fold(url: Column) -> Column:
    """Ruled URLs of this fold calibrate, the others teach."""
    return F.pmod(F.crc32(url), F.lit(4)) == 2


def _grams(url: str, order: int) -> Column:
    """The ``order + 1`` characters that end at each character of a URL and
    at its end."""
    whole = F.split(F.concat(F.lit(START * order), F.col(url), F.lit(END)), "")
    at = F.sequence(F.lit(1), F.size(whole) - order)
    return F.explode(F.transform(at, lambda i: F.array_join(F.slice(whole, i, order + 1), "")))


def rate_grams(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio) of ``counts`` (gram, a, b): the natural log of the last
    character's probability under the accepting model over that under the
    rejecting one, given the characters before it."""
    sizes = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("size")
    tail = F.expr("substring(gram, -size, size)").alias("tail")
    tails = counts.select("gram", "a", "b", sizes).select("a", "b", "size", tail)
    seen = cut_lineage(tails.groupBy("size", "tail").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-grams")
    context = F.expr("substring(tail, 1, size - 1)").alias("context")
    after = seen.select("size", context, "a", "b").groupBy("size", "context")
    after = after.agg(
        F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb")
    )
    known = seen.select("size", "tail", "a", "b", context).join(after, ["size", "context"]).drop("context")
    steps = counts.select("gram", sizes).select("gram", "size", tail).join(known, ["size", "tail"])
    steps = steps.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("size", "a", "na", "ta", "b", "nb", "tb"))).alias("steps"))

    def mixed(n: Column, total: Column, kinds: Column, shorter: Column) -> Column:
        return F.when(total > 0, (n + kinds * shorter) / (total + kinds)).otherwise(shorter)

    uniform = F.lit(1.0 / CODE_POINTS)
    fold = F.aggregate(
        "steps",
        F.struct(uniform.alias("p"), uniform.alias("q")),
        lambda s, x: F.struct(mixed(x["a"], x["na"], x["ta"], s["p"]).alias("p"), mixed(x["b"], x["nb"], x["tb"], s["q"]).alias("q")),
    )
    rated = steps.select("gram", fold.alias("s"))
    return rated.select("gram", (F.ln("s.p") - F.ln("s.q")).alias("ratio"))


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, n, verdict, score) of the distinct ``urls`` (id, url, n, verdict)
    that teach nothing: those without a verdict and those of the fold."""
    teaches = F.col("verdict").isNotNull() & ~in_fold(F.col("url"))
    of = lambda v: F.when(teaches & (F.col("verdict") == v), F.col("n")).otherwise(F.lit(0).cast("long"))
    parts = urls.select(_grams("url", order).alias("gram"), of("allow").alias("a"), of("block").alias("b"))
    counts = cut_lineage(parts.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-counts")
    rated = cut_lineage(rate_grams(counts, order), "url-model")
    asked = urls.where(~teaches).select("id", "n", "verdict", _grams("url", order).alias("gram"))
    # at most one row a character; the mean is taken to 9 digits, so that it
    # does not depend on the order of summing
    mean = F.round(F.sum("ratio") / F.count(F.lit(1)), 9).alias("score")
    return asked.join(rated, "gram").groupBy("id", "n", "verdict").agg(mean)


def score_bin(score: Column) -> Column:
    return F.greatest(F.lit(-MOST_BIN), F.least(F.lit(MOST_BIN), F.floor(score / BIN).cast("long")))


def cut_bin(scored: DataFrame) -> int:
    """The least bin that is accepted, by the ruled URLs of the fold.  At
    most ``2 * MOST_BIN + 1`` sums come to the driver."""
    both = scored.where(F.col("verdict").isNotNull()).groupBy(score_bin(F.col("score")).alias("bin"))
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(F.lit(0))).alias(v)
    rows = sorted((r["bin"], r["allow"], r["block"]) for r in both.agg(of("allow"), of("block")).collect())
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0
    cuts = {0} | {r[0] for r in rows} | {r[0] + 1 for r in rows}
    lost, i, best = 0, 0, None
    passed = bad
    for cut in sorted(cuts):
        while i < len(rows) and rows[i][0] < cut:
            lost, passed, i = lost + rows[i][1], passed - rows[i][2], i + 1
        # balanced error times good times bad times 2, a whole number
        found = (lost * bad + passed * good, abs(cut), cut)
        best = found if best is None or found < best else best
    return best[2]


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", order: int = ORDER) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the deciding one, else
    null), ``score`` (null where a rule decides) and ``verdict``."""
    ruled = with_rules(pages.drop("score"), rules, url)
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    ident = F.unhex(F.md5(text)).alias("id")
    urls = ruled.select(ident, text.alias("url"), "verdict").groupBy("id", "url", "verdict").agg(F.count(F.lit(1)).alias("n"))
    urls = cut_lineage(spread(urls, "id"), "urls")  # few bytes that become many rows
    scored = cut_lineage(scores(urls, order), "url-scores")
    cut = cut_bin(scored)
    judged = F.when(score_bin(F.col("score")) >= cut, "allow").otherwise("block")
    found = scored.where("verdict is null").select(F.col("id").alias("__id"), "score", judged.alias("verdict"))
    columns = [*[c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")], "host", "path", "rule", "score", "verdict"]
    decided = ruled.where("rule is not null").withColumn("score", F.lit(None).cast("double"))
    rest = ruled.where("rule is null").drop("verdict").withColumn("__id", F.unhex(F.md5(text))).join(found, "__id")
    return decided.select(*columns).unionByName(rest.select(*columns))
