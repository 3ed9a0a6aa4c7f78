"""TXT-01: lemmas of forms that the dictionary lacks, by edit trees.

An edit tree says how a form becomes its lemma: the longest common part
stays, and what is before and after it is changed by trees of its own, down to
replacements of whole parts.  A tree learnt from one pair applies to any form
that has the parts it replaces.

The dictionary's pairs teach a trie of endings, each alone and with the first
one or two letters: for each, the tree that most of its forms take, and their
share.  An unseen form takes, of the trees that apply to it, that of the
ending with the largest share (with one form added against it, so that an
ending seen once is no sure sign), ties to the longest.

Distinct pairs and distinct unseen forms are what is worked on, an ending
brings one tree to a form, and the trie is a table: nothing is collected.  A
trie of at most ``BROADCAST_ROWS`` endings goes to every task, where a form
finds its trees and takes one at once; a larger one is met by a shuffle.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ENDING = 12  # characters of the longest ending
HEAD = 2  # characters of a form's start that an ending may go with
BROADCAST_ROWS = 1_000_000  # endings
LONGEST = 64  # characters of a word that inflects; longer ones are left as they are


def edit_tree(form: str, lemma: str):
    """[replaced, by], [kept before, kept after, tree, tree], or None for no
    change."""
    if form == lemma:
        return None
    size, at, to = common_part(form, lemma)
    if not size:
        return [form, lemma]
    before, after = form[:at], form[at + size :]
    return [len(before), len(after), edit_tree(before, lemma[:to]), edit_tree(after, lemma[to + size :])]


def common_part(a: str, b: str) -> tuple[int, int, int]:
    """(length, start in a, start in b) of the longest common part; the first
    in a, then in b."""
    best, row = (0, 0, 0), [0] * (len(b) + 1)
    for i, x in enumerate(a):
        row = [0, *[row[j] + 1 if x == y else 0 for j, y in enumerate(b)]]
        longest = max(row)
        if longest > best[0]:
            j = row.index(longest)
            best = (longest, i + 1 - longest, j - longest)
    return best


def apply_tree(tree, form: str) -> str | None:
    """The lemma of a form, None if the tree does not apply to it."""
    if tree is None:
        return form
    if len(tree) == 2:
        return tree[1] if form == tree[0] else None
    n_before, n_after, before, after = tree
    if n_before + n_after >= len(form):  # the part that stays is not empty
        return None
    end = len(form) - n_after
    head, tail = apply_tree(before, form[:n_before]), apply_tree(after, form[end:])
    return None if head is None or tail is None else head + form[n_before:end] + tail


def _keys(form: str) -> F.Column:
    """(head, ending): up to two letters at the start, up to ENDING at the end."""
    size = F.length(form)

    def with_head(k: int) -> F.Column:
        longest = F.least(size - k, F.lit(ENDING))
        ending = lambda n: F.when(n > 0, F.substring(form, -n, n)).otherwise("")
        keys = F.transform(F.sequence(F.lit(0), longest), lambda n: F.struct(F.substring(form, 1, k).alias("head"), ending(n).alias("ending")))
        return F.when(size >= k, keys).otherwise(F.array().cast("array<struct<head:string,ending:string>>"))

    return F.explode(F.concat(*[with_head(k) for k in range(HEAD + 1)]))


def learn(lemmas: DataFrame) -> DataFrame:
    """(head, ending, tree, share): the commonest edit tree of every ending
    of the forms of ``lemmas`` (form, lemma), ties to the first by its text."""

    def run(batches):
        for b in batches:
            trees = [json.dumps(edit_tree(f, x), ensure_ascii=False) for f, x in zip(*(b.column(c).to_pylist() for c in range(2)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(trees, pa.string())], names=["form", "tree"])

    pairs = lemmas.select("form", "lemma").where(f"length(form) between 1 and {LONGEST} and length(lemma) <= {LONGEST}").distinct()
    known = pairs.mapInArrow(run, "form string, tree string")
    counts = known.select(_keys("form").alias("key"), "tree").groupBy("key", "tree").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("less"), "tree")).alias("b"), F.sum("n").alias("total"))
    return best.select("key.head", "key.ending", "b.tree", (-F.col("b.less") / (F.col("total") + 1)).alias("share"))


def _first(form: str, trees, known: dict) -> str | None:
    """The lemma by the first of ``trees`` that applies; ``known``: trees read before."""
    for t in trees:
        if t not in known:
            if len(known) > 100_000:
                known.clear()
            known[t] = json.loads(t)
        x = apply_tree(known[t], form)
        if x:
            return x
    return None


def _taken(batches):
    """(form, lemma) of rows (form, trees in their order)."""
    known = {}
    for b in batches:
        out = [_first(f, trees, known) for f, trees in zip(*(c.to_pylist() for c in b.columns))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["__form", "__lemma"])


def _taken_of_rows(batches):
    """(form, lemma) of rows (form, place and tree), those of a form together."""
    known, form, places = {}, None, []
    for b in batches:
        forms, out = [], []
        for f, *place in zip(*(c.to_pylist() for c in b.columns)):
            if f != form:
                if places:
                    forms.append(form)
                    out.append(_first(form, [p[-1] for p in sorted(places)], known))
                form, places = f, []
            places.append(place)
        yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array(out, pa.string())], names=["__form", "__lemma"])
    if places:
        last = [_first(form, [p[-1] for p in sorted(places)], known)]
        yield pa.RecordBatch.from_arrays([pa.array([form], pa.string()), pa.array(last, pa.string())], names=["__form", "__lemma"])


def guess(forms: DataFrame, model: DataFrame, form: str = "form") -> DataFrame:
    """``forms`` (distinct) with ``lemma``: that of the surest ending whose
    tree applies, the form itself if none does."""
    model = cut_lineage(model, "endings", "zstd")
    short = forms.where(F.length(form).between(1, LONGEST)).select(F.col(form).alias("__form"))
    keys = short.select("__form", _keys("__form").alias("key")).select("__form", "key.*")
    place = F.struct((-F.col("share")).alias("share"), (-F.length("ending")).alias("ending"), (-F.length("head")).alias("head"), "tree")
    if model.count() <= BROADCAST_ROWS:
        # the trees of a form follow each other, as its keys do
        trees = keys.join(F.broadcast(model), ["head", "ending"]).select("__form", place.alias("place")).select("__form", "place.*")
        run = _taken_of_rows
    else:
        trees = keys.join(model, ["head", "ending"]).groupBy("__form").agg(F.array_sort(F.collect_list(place)).alias("places"))
        trees = trees.select("__form", F.col("places.tree").alias("trees"))
        run = _taken
    found = trees.mapInArrow(run, "__form string, __lemma string")
    j = forms.drop("lemma").join(found, forms[form] == F.col("__form"), "left")
    return j.withColumn("lemma", F.coalesce("__lemma", form)).drop("__form", "__lemma")
