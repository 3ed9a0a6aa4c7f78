import gc
import math
import weakref
from collections import Counter
from unittest.mock import MagicMock

import pyarrow as pa

from deckspark.llm import language_id as I
from deckspark.llm import bpe_automaton, line_dedup, simhash_gray, storage
from deckspark.llm.queries import QUERIES, table, tokenizer_path


def by_hand(teach, text):
    """The definition with plain counters."""
    counts = {}
    for lang, t in teach:
        for w in I.words(t):
            counts.setdefault((lang, 0), Counter())[w] += 1
            for n in range(1, I.NGRAMS + 1):
                counts.setdefault((lang, n), Counter()).update(I.grams(w, n))
    langs = sorted({lang for lang, _ in counts})

    def cost(lang, n, item):
        c = counts.get((lang, n), Counter())
        return -math.log10(c[item] / sum(c.values())) if c[item] else I.PENALTY

    def word(lang, w):
        if any(counts[x, 0][w] for x in langs):
            return cost(lang, 0, w)
        for n in range(I.NGRAMS, 0, -1):
            known = [g for g in I.grams(w, n) if any(counts[x, n][g] for x in langs if (x, n) in counts)]
            if known:
                return sum(cost(lang, n, g) for g in known) / len(known)
        return I.PENALTY

    found = I.words(text or "")
    if not found or not langs:
        return "und", 0.0
    mean = [sum(word(lang, w) for w in found) / len(found) for lang in langs]
    best = min(mean)
    return langs[mean.index(best)], 1 / sum(math.exp(-I.SHARPNESS * (x - best)) for x in mean)


def test_as_by_hand(spark, edge_docs, edge_rows, no_docs):
    teach = [(lang, t) for _, t, lang in edge_rows if lang and t]
    got = I.predict(edge_docs, I.train(edge_docs)).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        lang, score = by_hand(teach, r.text)
        assert (r.lang_pred, round(r.score, 9)) == (lang, round(score, 9)), r.doc_id
        assert r.h == 0.5 and r.fp == "x"  # other columns pass through
    assert {r.lang_pred for r in I.predict(edge_docs, I.train(no_docs)).collect()} == {"und"}
    assert I.predict(no_docs, I.train(edge_docs)).count() == 0


def test_filter_keeps_rows_whole(edge_docs, no_docs):
    kept = I.filter_known(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert {r.score for r in rows} == {"y"}  # the column of that name is the input's
    assert not {4, 5, 6} & {r.doc_id for r in rows} and {1, 2, 3, 8, 10} <= {r.doc_id for r in rows}
    assert I.filter_known(no_docs).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


class _Captured:
    """Stands for a table and its session; keeps the function of its tasks."""

    schema: list = []

    def __init__(self, value=None):
        self.sparkSession = self.sparkContext = self
        self.found = value

    def broadcast(self, value):
        return _Loaded(value)

    def same(self, *_):
        return self

    select = drop = where = withColumn = groupBy = agg = same

    def mapInArrow(self, run, _schema):
        self.run = run
        return self


class _Loaded:
    def __init__(self, model):
        self.model = model

    @property
    def value(self):
        assert not storage._HELD  # what others keep is freed before the model is loaded
        return self.model


class _Trained:
    def toArrow(self):
        return pa.table({"lang": ["en"], "size": [0], "item": ["a"], "cost": [0.0]})


def test_tasks_free_what_other_stages_keep(monkeypatch):
    kept: dict = {}
    monkeypatch.setattr(storage, "_HELD", kept)
    monkeypatch.setattr(I, "F", MagicMock())
    for make in (I.word_counts, lambda t: I.predict(t, _Trained())):
        kept["codec"] = object()
        make(table := _Captured())
        list(table.run([]))
        assert "codec" not in kept
        kept.clear()


def test_other_stages_free_it_too(monkeypatch):
    kept: dict = {}
    monkeypatch.setattr(storage, "_HELD", kept)
    for module, make in ((line_dedup, line_dedup.lines), (simhash_gray, lambda t: simhash_gray._fingerprints(t, 3))):
        monkeypatch.setattr(module, "F", MagicMock())
        kept["codec"] = object()
        make(table := _Captured())
        list(table.run([]))
        assert not kept


def test_a_codec_is_freed_whole(monkeypatch):
    """With its automaton and the transitions that it has computed."""
    monkeypatch.setattr(storage, "_HELD", {})
    path = tokenizer_path()
    automaton = weakref.ref(storage.held("codec", lambda: bpe_automaton.Codec(path, "")).machine)
    assert automaton() is not None
    storage.release()
    gc.collect()
    assert automaton() is None
