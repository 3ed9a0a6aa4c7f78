"""String column functions (STR-*) built from JVM-side Spark expressions.

Every function takes and returns a ``Column``; none of them leaves
whole-stage codegen.  Regexes stay within the subset that Java and RE2 share
(no look-around, no back-references) so the DuckDB oracles can mirror them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ARTICLES_FULL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# STR-01 -- Python-style strip: all Unicode whitespace, no-break spaces too.
def strip(c) -> Column:
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


# STR-02
def strip_chars(c, chars: str) -> Column:
    return F.btrim(_c(c), F.lit(chars))


# STR-03
def lower(c) -> Column:
    return F.lower(_c(c))


# STR-04
def replace(c, old: str, new: str) -> Column:
    return F.replace(_c(c), F.lit(old), F.lit(new))


# STR-05 -- newline to the two characters backslash + n
def escape_newlines(c) -> Column:
    return F.replace(_c(c), F.lit("\n"), F.lit("\\n"))


# STR-06
def interpolate(fmt: str, *cols) -> Column:
    return F.format_string(fmt, *[_c(c) for c in cols])


# STR-07 -- media file slug: prefix___topic___word.jpg, lower case, spaces -> '-'
def media_name(topic, word, prefix: str, ext: str = "jpg") -> Column:
    def slug(x):
        return F.replace(F.lower(_c(x)), F.lit(" "), F.lit("-"))

    return F.concat(F.lit(prefix + "___"), slug(topic), F.lit("___"), slug(word), F.lit("." + ext))


# STR-08
def image_tag(c) -> Column:
    return F.format_string('<img src="%s">', _c(c))


# STR-09 -- length in code points, as Python len()
def length(c) -> Column:
    return F.char_length(_c(c)).cast("bigint")


# STR-10 -- 1-based substring
def substr(c, pos: int, n: int) -> Column:
    return F.substring(_c(c), pos, n)


# STR-11 -- text before the first '.', '(' or ',', stripped
def cut_annotation(c) -> Column:
    c = _c(c)
    return F.when(c.rlike(r"[.(,]"), strip(F.regexp_extract(c, r"^([^.(,]*)", 1))).otherwise(c)


# STR-12 -- dictionary (base) form of a deck word
def base_form(c) -> Column:
    """Bare article stays; annotation after . ( , is cut; a capitalised word
    stays; ``article + space + ...`` keeps the text from the first capital;
    anything else is returned unchanged."""
    c = _c(c)
    cut = cut_annotation(c)
    with_article = (
        F.substring(cut, 1, 3).isin(*ARTICLES_FULL)
        & (F.substring(cut, 4, 1) == " ")
        & cut.rlike(r"\p{Lu}")
    )
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.isin(*ARTICLES_FULL), c)
        .when(cut.rlike(r"^\p{Lu}"), cut)
        .when(with_article, F.regexp_extract(cut, r"(?s)^[^\p{Lu}]*(\p{Lu}.*)$", 1))
        .otherwise(cut)
    )


# STR-13 -- keep letters, digits, space and hyphen (newlines become spaces first)
def keep_word_chars(c) -> Column:
    return F.regexp_replace(F.replace(_c(c), F.lit("\n"), F.lit(" ")), r"[^\p{L}\p{N} -]", "")


# STR-14
def is_capitalised(c) -> Column:
    return _c(c).rlike(r"^\p{Lu}")


def starts_with_digit(c) -> Column:
    return _c(c).rlike(r"^\p{Nd}")


# STR-15 -- zero pad, never truncating a longer value (Python f"{n:0w}")
def pad(c, width: int) -> Column:
    s = _c(c).cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.char_length(s)), F.lit("0"))


# STR-16 -- fixed decimals, no thousands separators
def fixed(c, digits: int = 3) -> Column:
    return _c(c).cast(f"decimal(18,{digits})").cast("string")


# STR-17 -- index label: integers without '.0', fractions without trailing zeros
def index_label(c) -> Column:
    s = _c(c).cast("decimal(18,6)").cast("string")
    trimmed = F.regexp_replace(s, r"0+$", "")
    return F.regexp_replace(trimmed, r"\.$", "")


# STR-18 -- tokens = split on one space (repeated spaces give empty tokens)
def token_count(c) -> Column:
    return F.size(F.split(_c(c), " ")).cast("bigint")


# STR-19 -- rule-based sentence split: break after . ! ? followed by space(s)
# or at a newline.  Returns array<string> of stripped, non-empty sentences.
def split_sentences(c) -> Column:
    marked = F.regexp_replace(_c(c), r"([.!?])[ \t]+", "$1\n")
    parts = F.split(marked, "\n")
    return F.filter(F.transform(parts, lambda x: strip(x)), lambda x: x != "")


# STR-20 -- '/' -> '.', and '.' appended when the original line ends with '"'
def fix_sentence(c) -> Column:
    c = _c(c)
    fixed_ = F.replace(c, F.lit("/"), F.lit("."))
    return F.when(c.endswith('"'), F.concat(fixed_, F.lit("."))).otherwise(fixed_)


# STR-21
def escape_quotes(c) -> Column:
    return F.replace(_c(c), F.lit('"'), F.lit('""'))


# STR-22 -- right-trim every line, rejoin, strip the whole text
def clean_lines(c) -> Column:
    lines = F.split(_c(c), "\n")
    return strip(F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, r"\s+$", "")), "\n"))


# STR-23 -- last path segment of a URL; URL assembly from base + padded number
def url_basename(c) -> Column:
    return F.element_at(F.split(_c(c), "/"), -1)


def url_join(base, number, width: int = 3) -> Column:
    return F.concat(_c(base), pad(number, width))


# STR-24 -- percent-encoding with Python quote semantics (safe="/" default)
def url_quote(c, safe: str = "/") -> Column:
    enc = F.url_encode(_c(c))
    # Java's encoder: space -> '+', '*' kept, '~' encoded; Python quote: '%20', '*' -> %2A, '~' kept
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    for ch in safe:
        enc = F.replace(enc, F.lit("%%%02X" % ord(ch)), F.lit(ch))
    return enc


# STR-25 -- path after the API version segment, two patterns tried in order
def url_endpoint(c) -> Column:
    c = _c(c)
    first = F.regexp_extract(c, r"^https?://[^/]+/v\d+/(.+)$", 1)
    second = F.regexp_extract(c, r"^https?://[^/]+/[^/]+/(.+)$", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")))


# STR-26 -- strip Markdown code fences
def strip_fences(c) -> Column:
    c = F.replace(_c(c), F.lit("```csv"), F.lit(""))
    c = F.replace(c, F.lit("```text"), F.lit(""))
    return F.replace(c, F.lit("```"), F.lit(""))


# STR-27 -- normalise a table row: strip, strip '|', strip, ' | ' -> '|'
def clean_row(c) -> Column:
    x = strip(_c(c))
    x = strip(F.btrim(x, F.lit("|")))
    return F.replace(x, F.lit(" | "), F.lit("|"))


# STR-28 -- ordinal range label; the suffixes are fixed 'st' / 'th'
def range_label(lo, hi) -> Column:
    return F.format_string("the %sst to the %sth", _c(lo).cast("string"), _c(hi).cast("string"))


# STR-29 -- half-open range label "[ a ; b )" with clamp and offset
def mkrange(start, end, maxi=None, offset=0) -> Column:
    s = _c(start) + F.lit(offset)
    e = _c(end) + F.lit(offset)
    if maxi is not None:
        e = F.least(e, maxi if isinstance(maxi, Column) else F.lit(maxi))
    return F.format_string("[ %s ; %s )", s.cast("string"), e.cast("string"))


# STR-30 -- n-th space-separated field, last character dropped, as int
def field_as_int(c, n: int) -> Column:
    field = F.try_element_at(F.split(_c(c), " "), F.lit(n))
    return F.regexp_replace(field, r".$", "").try_cast("int")


# FL-02 helper -- code-point length in [lo, hi], null is out
def length_between(c, lo: int, hi: int) -> Column:
    c = _c(c)
    return c.isNotNull() & F.char_length(c).between(lo, hi)


# FL-16 -- case-insensitive regex search on a field
def search(c, regex: str) -> Column:
    return _c(c).rlike("(?i)" + regex)


# TXT-26 -- article / word split of "die Sonne", and the last word of a line
def split_article(c) -> Column:
    m = F.regexp_extract(_c(c), r"^(der|die|das) (.+)$", 1)
    return F.nullif(m, F.lit(""))


def article_word(c) -> Column:
    c = _c(c)
    w = F.regexp_extract(c, r"^(der|die|das) (.+)$", 2)
    return F.when(w == "", c).otherwise(w)


def last_word(c) -> Column:
    return F.element_at(F.split(strip(_c(c)), " "), -1)
