"""Operator 5: language identification by word-first backoff.

The model holds, per language, the log relative frequency of words and of
character n-grams of words (with their borders marked).  A known word scores
its own frequencies; an unknown word falls back to its longest n-grams of
which one is known, and so on down to single characters.  A text's score per
language is the mean over its words; languages that lack an item get a
penalty.

Counts cover all learning rows.  The model keeps items whose relative
frequency within a language reaches ``MIN_SHARE``: at most ``1 / MIN_SHARE``
words, and as many n-grams of each length, per language whatever the size of
the corpus, which bounds what is sent to the tasks.

Defined results: null text or a text without a letter gives ``und`` with
score 0; ties go to the first language by name; texts are read whole; an
empty model (no learning rows) gives ``und`` for every row; rows with null
language or text teach nothing; other columns pass through in
:func:`filter_known` and are ignored elsewhere.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .storage import cut_lineage, held, release

NGRAMS = 5
MIN_SHARE = 2e-6
PENALTY = 8.0  # -log10 frequency of an item that a language lacks
SHARPNESS = 8.0  # score differences to probabilities
UND = "und"
MEMO = 300_000
SUMMED = 200_000  # distinct words a task sums before it hands counts on
ROWS = 512  # rows of a batch that are texts in Python at a time

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, lower case."""
    return _LETTERS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) over whole texts; a task sums before the shuffle."""

    def run(batches):
        release()
        counts: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, counts.values())) > SUMMED:
                yield _counts(counts)
                counts = {}
        yield _counts(counts)

    summed = rows.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return summed.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _counts(counts: dict[str, Counter]) -> pa.RecordBatch:
    """The words of the counted pieces, by language."""
    out: Counter = Counter()
    for lang, pieces in counts.items():
        for piece, n in pieces.items():
            for w in [piece] if piece.isalpha() else _LETTERS.findall(piece):
                out[lang, w] += n
    keys = list(out)
    cols = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(out.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=["lang", "word", "n"])


def train(rows: DataFrame, n_grams: int = NGRAMS, min_share: float = MIN_SHARE) -> DataFrame:
    """(lang, size, item, cost): size 0 for words, else the n-gram length;
    cost is -log10 of the relative frequency."""
    teach = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = cut_lineage(word_counts(teach.where("lang is not null and text is not null")), "word-counts")
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    sizes = F.explode(F.sequence(F.lit(1), F.lit(n_grams))).alias("size")
    parts = counts.select("lang", "n", padded.alias("p"), sizes).where("length(p) >= size")
    parts = parts.select("lang", "n", "size", "p", F.explode(F.expr("sequence(1, length(p) - size + 1)")).alias("at"))
    items = parts.select("lang", "size", F.expr("substring(p, at, size)").alias("item"), "n").union(
        counts.select("lang", F.lit(0).alias("size"), F.col("word").alias("item"), "n")
    )
    items = items.groupBy("lang", "size", "item").agg(F.sum("n").alias("n"))
    totals = items.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    # totals: a row per language and size
    return items.join(totals, ["lang", "size"]).where(share >= min_share).select("lang", "size", "item", (-F.log10(share)).alias("cost"))


class Model:
    """Cost vectors of words and n-grams, languages in order of name."""

    def __init__(self, table: pa.Table):
        cols = {c: table.column(c).to_pylist() for c in ("lang", "size", "item", "cost")}
        self.langs = sorted(set(cols["lang"]))
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.longest = max(cols["size"], default=0)
        # item -> its row of costs, for words (0) and n-grams by length
        self.place: list[dict[str, int]] = [{} for _ in range(self.longest + 1)]
        rows, n = [], 0
        for size, item in zip(cols["size"], cols["item"]):
            k = self.place[size].setdefault(item, n)
            n += k == n
            rows.append(k)
        self.cost = np.full((n, len(self.langs)), PENALTY)
        self.cost[rows, [at[x] for x in cols["lang"]]] = cols["cost"]

    def word(self, w: str) -> np.ndarray:
        k = self.place[0].get(w)
        if k is not None:
            return self.cost[k]
        padded = f" {w} "
        for n in range(self.longest, 0, -1):
            get = self.place[n].get
            known = [k for i in range(len(padded) - n + 1) if (k := get(padded[i : i + n])) is not None]
            if known:
                return np.add.reduce(self.cost.take(known, axis=0)) / len(known)
        return np.full(len(self.langs), PENALTY)

    def piece(self, piece: str) -> np.ndarray:
        """Summed costs of a piece's words, and their number at the end."""
        found = words(piece)
        out = np.zeros(len(self.langs) + 1)
        for w in found:
            out[:-1] += self.word(w)
        out[-1] = len(found)
        return out

    def predict(self, text: str | None, memo: _Memo) -> tuple[str, float]:
        if not text or not self.langs:
            return UND, 0.0
        parts, total = text.split(), np.zeros(len(self.langs) + 1)
        for at in range(0, len(parts), MEMO // 2):
            some = parts[at : at + MEMO // 2]
            if len(memo) + len(some) > MEMO:
                memo.clear()
            total += np.add.reduce(memo.rows.take(list(map(memo.__getitem__, some)), axis=0))
        if not total[-1]:
            return UND, 0.0
        mean = total[:-1] / total[-1]
        best = int(mean.argmin())
        p = 1.0 / sum(math.exp(min(0.0, -SHARPNESS * (x - mean[best]))) for x in mean.tolist())
        return self.langs[best], float(p)


class _Memo(dict):
    """piece -> row of its costs; emptied when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows = model, np.zeros((MEMO, len(model.langs) + 1))

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.rows[k] = self.model.piece(piece)
        return k


def predict(docs: DataFrame, model: DataFrame, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score under ``names`` (columns of
    those names are replaced); only ``text`` is read.  One scan, no shuffle."""
    # bounded: at most (NGRAMS + 1) / MIN_SHARE items per language
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.toArrow()))
    docs, key = docs.drop(*names), ("languages", uuid.uuid4().hex)

    def run(batches):
        memo = held(key, lambda: _Memo(sent.value))  # loaded when others are freed
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                found = [memo.model.predict(t, memo) for t in b.column(text).to_pylist()]
                cols = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *names])

    fields = [StructField(f.name, f.dataType) for f in docs.schema]
    return docs.mapInArrow(run, StructType([*fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))


def held_out(mod: int, remainder: int):
    """Is the document in the fold that learning must not see?  A null id
    counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(mod)) == remainder


def filter_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is recognised: not ``und``, and with a score
    of at least ``least`` (languages that are close share the probability).
    Learns from the rows of ``docs`` with a language."""
    model = train(docs.where(~held_out(4, 2)))
    lang, sure = "__lang_found", "__score_found"
    found = predict(docs, model, names=(lang, sure))
    return found.where((F.col(lang) != UND) & (F.col(sure) >= least)).select(*docs.columns)
