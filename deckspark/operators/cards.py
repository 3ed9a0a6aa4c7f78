"""Card templates and cloze notes (TXT-06..09).

Templates are a small, fixed set of strings given by the caller; cards are
produced by exploding a literal array of templates per note (no join), and
placeholders are filled with chained ``replace`` in one JVM expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACEHOLDER = r"\{\{[^}]*\}\}"


def fill(template, fields: dict[str, Column]) -> Column:
    """Replace ``{{name}}`` by the field value (null -> empty string)."""
    out = template if isinstance(template, Column) else F.lit(template)
    for name, col in fields.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(col.cast("string"), F.lit("")))
    return out


# TXT-06
def render_template(df: DataFrame, template: str, cols: list[str], out: str = "rendered", strict: bool = False) -> DataFrame:
    """With ``strict`` a placeholder that is left over is an error: at once
    if the template names what ``cols`` does not hold, and when the rows are
    computed if a field brings one in."""
    filled = fill(template, {c: F.col(c) for c in cols})
    if not strict:
        return df.withColumn(out, filled)
    left = [p for p in re.findall(PLACEHOLDER, template) if p[2:-2] not in cols]
    if left:
        raise ValueError(f"nothing fills {', '.join(left)}")
    df = df.withColumn(out, filled)
    told = F.concat(F.lit("nothing fills "), F.array_join(unresolved(out), ", "))
    return df.withColumn(out, F.when(F.size(unresolved(out)) > 0, F.raise_error(told)).otherwise(F.col(out)))


def unresolved(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("(" + PLACEHOLDER + ")"), 1)


def _sections(tpl: Column, fields: dict[str, Column]) -> Column:
    """``{{#f}}..{{/f}}`` kept when f is non-empty, ``{{^f}}..{{/f}}`` when empty."""
    out = tpl
    for name, col in fields.items():
        empty = F.coalesce(F.trim(col.cast("string")), F.lit("")) == ""
        keep_pos = F.regexp_replace(out, r"\{\{[#]" + name + r"\}\}|\{\{/" + name + r"\}\}", "")
        drop_pos = F.regexp_replace(out, r"(?s)\{\{#" + name + r"\}\}.*?\{\{/" + name + r"\}\}", "")
        out = F.when(empty, drop_pos).otherwise(keep_pos)
        keep_neg = F.regexp_replace(out, r"\{\{\^" + name + r"\}\}|\{\{/" + name + r"\}\}", "")
        drop_neg = F.regexp_replace(out, r"(?s)\{\{\^" + name + r"\}\}.*?\{\{/" + name + r"\}\}", "")
        out = F.when(empty, keep_neg).otherwise(drop_neg)
    return out


# TXT-07 -- front/back per note and template; back sees {{FrontSide}};
# {{tts ...}} and other non-field tags pass through unchanged.
def render_cards(notes: DataFrame, templates: list[tuple[str, str, str]], fields: list[str]) -> DataFrame:
    tpl = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f).alias("front"), F.lit(b).alias("back")) for n, f, b in templates])
    x = notes.withColumn("__t", F.explode(tpl))
    fmap = {c: F.col(c) for c in fields}
    front = fill(_sections(F.col("__t.front"), fmap), fmap)
    x = x.withColumn("template", F.col("__t.name")).withColumn("front", front)
    back = fill(_sections(F.col("__t.back"), fmap), fmap)
    back = F.replace(back, F.lit("{{FrontSide}}"), F.col("front"))
    return x.withColumn("back", back).drop("__t")


# TXT-08 -- one card per distinct cloze number; that deletion hidden as
# [...], the others shown as their text.  All regexes are constants (compiled
# once per task); the per-card substitution is a literal replace over the
# note's own list of deletions.
CLOZE_FULL = r"(\{\{c\d+::[^}]*\}\})"
CLOZE_ID = r"\{\{c(\d+)::[^}]*\}\}"
CLOZE_TEXT = r"\{\{c\d+::([^}]*)\}\}"


def expand_cloze(notes: DataFrame, text: str, out_n: str = "cloze") -> DataFrame:
    t = F.col(text)
    dels = F.arrays_zip(
        F.regexp_extract_all(t, F.lit(CLOZE_FULL), 1).alias("m"),
        F.regexp_extract_all(t, F.lit(CLOZE_ID), 1).alias("n"),
        F.regexp_extract_all(t, F.lit(CLOZE_TEXT), 1).alias("v"),
    )
    # numbers are compared as written, and need not fit an int
    x = notes.withColumn("__d", dels)
    x = x.withColumn("__n", F.explode(F.array_distinct(F.transform("__d", lambda d: d["n"])))).withColumn(out_n, F.col("__n").try_cast("int"))
    front = F.aggregate("__d", t, lambda acc, d: F.replace(acc, d["m"], F.when(d["n"] == F.col("__n"), F.lit("[...]")).otherwise(d["v"])))
    back = F.aggregate("__d", t, lambda acc, d: F.replace(acc, d["m"], d["v"]))
    return x.withColumn("front", front).withColumn("back", back).drop("__d", "__n")


# TXT-09 -- the typed answer of cloze n
def cloze_answer(text, n) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    nn = (F.col(n) if isinstance(n, str) else F.lit(n)).cast("string")
    dels = F.arrays_zip(F.regexp_extract_all(t, F.lit(CLOZE_ID), 1).alias("n"), F.regexp_extract_all(t, F.lit(CLOZE_TEXT), 1).alias("v"))
    hit = F.filter(dels, lambda d: d["n"] == nn)
    return F.coalesce(F.try_element_at(hit, F.lit(1))["v"], F.lit(""))


def cloze_note(a, b, c, op: str = "×") -> Column:
    """A product fact as a three-deletion cloze note: {{c1::a}} op {{c2::b}} = {{c3::c}}."""
    return F.format_string("{{c1::%s}} " + op + " {{c2::%s}} = {{c3::%s}}", a.cast("string"), b.cast("string"), c.cast("string"))
