"""Elements of HTML pages as Column expressions.

A page becomes an array of tokens (tags, comments, runs of text).  Elements
are matched by a fold that carries a depth counter, so an element ends at its
own closing tag, whatever elements of the same name it holds.  Everything
works on arrays of tokens, so a search goes on inside what another has found:
``inner(first(elements(tokens(c), "div", has_class("content"))))`` and so on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: entities decoded after tag stripping, in this order ----
HTML_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

# a comment; a tag, whose quoted values may hold ">"; text; a lone "<"
TOKEN = r"""(?s)<!--.*?-->|</?[a-zA-Z][^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>|<[!?][^>]*>|[^<]+|<"""
TAG = r"(?s)^(<!--|</?[a-zA-Z].*>$|<[!?].*>$)"
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def visible(html) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(_c(html), HIDDEN, "")


def tokens(html) -> Column:
    """The page's tags and texts, in order; a null page has none."""
    return F.coalesce(F.regexp_extract_all(_c(html), F.lit(TOKEN), 0), F.array().cast("array<string>"))


def is_tag(token) -> Column:
    return _c(token).rlike(TAG)


def attribute(token, name: str) -> Column:
    """Value of a tag's attribute, null where it has none."""
    found = rf"""(?is)^<[a-z][^\s>]*(?:\s[^>]*?)?\s{name}(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?[\s/>]"""
    t = _c(token)
    value = F.concat(*[F.regexp_extract(t, found, k) for k in (1, 2, 3)])
    return F.when(t.rlike(found), value)


def has_attribute(name: str, value: str | None = None):
    """Condition for :func:`elements`."""
    return lambda t: attribute(t, name).isNotNull() if value is None else F.coalesce(attribute(t, name) == value, F.lit(False))


def has_class(name: str):
    """Condition: one of the classes is ``name``."""
    return lambda t: F.coalesce(F.array_contains(F.split(attribute(t, "class"), r"\s+"), name), F.lit(False))


def elements(toks, name: str, where=None, nested: bool = False) -> Column:
    """array<array<string>>: the tokens of every element ``name`` whose
    opening tag meets ``where``, from its opening to before its closing tag,
    in order of their openings.  Without ``nested`` those inside a found one
    are part of it only.  Closing tags that close nothing are ignored; an
    element that is never closed ends with the tokens."""
    toks = _c(toks)
    opens, closes = rf"(?is)^<{name}(\s[^>]*)?/?>", rf"(?i)^</{name}\s*>"
    kind = lambda t: F.when(t.rlike(closes), -1).when(t.rlike(opens) & ~t.endswith("/>"), 1).otherwise(0)
    hit = lambda t: F.lit(True) if where is None else where(t)
    events = F.transform(toks, lambda t, i: F.when(kind(t) != 0, F.struct(i.cast("int").alias("i"), kind(t).alias("kind"), hit(t).alias("hit"))))
    events = F.filter(events, lambda e: e.isNotNull())
    spans = F.array().cast("array<struct<a:int,b:int>>")
    found = _nested(events, spans, F.size(toks)) if nested else _outermost(events, spans, F.size(toks))
    return F.transform(found, lambda s: F.slice(toks, s["a"] + 1, s["b"] - s["a"]))


def _span(a: Column, b: Column) -> Column:
    return F.array(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))


def _outermost(events: Column, spans: Column, size: Column) -> Column:
    def step(s, e):
        inside = s["depth"] > 0
        begins = ~inside & (e["kind"] == 1) & e["hit"]
        depth = F.when(inside, s["depth"] + e["kind"]).when(begins, 1).otherwise(0)
        return F.struct(
            depth.cast("int").alias("depth"),
            F.when(begins, e["i"]).otherwise(s["a"]).cast("int").alias("a"),
            F.when(inside & (depth == 0), F.concat(s["out"], _span(s["a"], e["i"]))).otherwise(s["out"]).alias("out"),
        )

    zero = F.lit(0).cast("int")
    done = lambda s: F.when(s["depth"] > 0, F.concat(s["out"], _span(s["a"], size))).otherwise(s["out"])
    return F.aggregate(events, F.struct(zero.alias("depth"), zero.alias("a"), spans.alias("out")), step, done)


def _nested(events: Column, spans: Column, size: Column) -> Column:
    """With a stack of the open elements (-1 for those not asked for)."""
    def step(s, e):
        top = F.try_element_at(s["open"], F.lit(-1))
        closing = e["kind"] == -1
        kept = F.when(closing & (top >= 0), F.concat(s["out"], _span(top, e["i"]))).otherwise(s["out"])
        place = F.array(F.when(e["hit"], e["i"]).otherwise(F.lit(-1)).cast("int"))
        left = F.slice(s["open"], 1, F.greatest(F.size(s["open"]) - 1, F.lit(0)))
        return F.struct(F.when(closing, left).otherwise(F.concat(s["open"], place)).alias("open"), kept.alias("out"))

    def done(s):
        rest = F.transform(F.filter(s["open"], lambda a: a >= 0), lambda a: F.struct(a.alias("a"), size.cast("int").alias("b")))
        return F.array_sort(F.concat(s["out"], rest))

    return F.aggregate(events, F.struct(F.array().cast("array<int>").alias("open"), spans.alias("out")), step, done)


def first(found) -> Column:
    """The first of the elements, null where there is none."""
    return F.get(_c(found), 0)


def inner(element) -> Column:
    """An element's tokens without its opening tag."""
    e = _c(element)
    return F.slice(e, 2, F.greatest(F.size(e) - 1, F.lit(0)))


def decode(text) -> Column:
    x = _c(text)
    for entity, char in HTML_ENTITIES:
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def text_of(toks, sep: str = "") -> Column:
    """The texts of an array of tokens, with ``sep`` for every tag."""
    return decode(F.array_join(F.transform(_c(toks), lambda t: F.when(is_tag(t), sep).otherwise(t)), ""))


def strip_tags(c, replacement: str = "") -> Column:
    return decode(F.regexp_replace(_c(c), r"<[^>]*>", replacement))
