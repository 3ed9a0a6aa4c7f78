"""Operator 9: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts of the learning fold, whatever
their label, are the unlabelled sample.  With the class prior ``pi`` the risk
of a score function ``g`` is

    pi * E_pos[l(g)] + max(0, E_unl[l(-g)] - pi * E_pos[l(-g)])

with the logistic loss ``l``; when the second part is negative the step
goes against it, as the non-negative estimator prescribes.  The classifier is
linear over the presence of words, each scaled by how significantly its
shares in the two samples differ (a z score), so that rare words that differ
by chance weigh little.  It is trained by numpy in one task on a bounded
sample; the number of steps is the one with the least risk on a fifth of that
sample that a first training does not see.

Bounds, as parameters: at most about ``POSITIVES`` confirmed and
``UNLABELLED`` unlabelled texts, drawn by a hash of id and text and counted
once however often they repeat, and the ``VOCABULARY`` words of the strongest
scores.  The prior counts over all labelled learning rows.

Defined results: a null text is an empty text; an empty text scores the bias
alone; without any confirmed positive the score is 0 for every text; texts
are read whole; repeated rows score alike; null ids are never confirmed; other
columns pass through.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .storage import cut_lineage

POSITIVES = 10_000
UNLABELLED = 20_000
VOCABULARY = 20_000
STEPS = 400  # at most
CHECK = 50  # steps between two looks at the risk of unseen texts
MEMO = 300_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    out: set[str] = set()
    for piece in set((text or "").lower().split()):
        if piece.isalpha():
            out.add(piece)
        else:
            out.update(_LETTERS.findall(piece))
    return out


def _share(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """About ``most`` rows at random by a hash of the columns ``by``, those
    with equal ones once; all, if fewer."""
    n = rows.count()
    drawn = rows.where(F.pmod(F.xxhash64(*by, F.lit(9)), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, most / max(n, 1))))
    return drawn.dropDuplicates(list(by))


def sample_words(docs: DataFrame, positive_ids: DataFrame) -> DataFrame:
    """(positive, words array<string>) of the bounded sample."""
    ids = _share(positive_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct(), POSITIVES, "doc_id")
    text = F.col("text").cast("string")
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    # about POSITIVES ids: a bounded broadcast
    found = cols.join(F.broadcast(ids), "doc_id", "left_semi").dropDuplicates(["doc_id", "th"])
    positive = _share(cut_lineage(found, "toxicity-positives"), POSITIVES, "doc_id", "th")
    unlabelled = _share(cols, UNLABELLED, "doc_id", "th")
    both = positive.select(F.lit(True).alias("positive"), "text").union(unlabelled.select(F.lit(False), "text"))

    def run(batches):
        for b in batches:
            found = [sorted(words(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("positive"), pa.array(found, pa.list_(pa.string()))], names=["positive", "words"])

    return both.mapInArrow(run, "positive boolean, words array<string>")


def train(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, weight), the bias under the null word, from learning rows
    only: ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of that
    fold."""
    marked = labels.where("toxic is not null")
    counted = marked.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("prior")).first()
    prior = counted["prior"] or 0.0
    spark = docs.sparkSession
    if prior <= 0.0:
        return spark.createDataFrame([], "word string, weight double")
    prior = min(prior, 0.9)
    sample = cut_lineage(sample_words(docs, marked.where("toxic = 1")), "toxicity-sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl:
        return spark.createDataFrame([], "word string, weight double")
    each = sample.select("positive", F.explode("words").alias("word"))
    known = each.groupBy("word").agg(
        F.sum(F.col("positive").cast("long")).alias("p"), F.sum((~F.col("positive")).cast("long")).alias("u")
    )
    p, u = F.col("p") / F.lit(n_pos), F.col("u") / F.lit(n_unl)
    share = (F.col("p") + F.col("u") + 1) / F.lit(n_pos + n_unl + 2)
    z = (p - u) / F.sqrt(share * (1 - share) * F.lit(1 / n_pos + 1 / n_unl))
    strongest = known.withColumn("z", z).orderBy(F.abs("z").desc(), "word").limit(VOCABULARY).select("word", "z").collect()
    place = {r["word"]: i for i, r in enumerate(strongest)}
    scale = np.array([r["z"] for r in strongest])
    sent = spark.sparkContext.broadcast((place, scale))

    def index(batches):
        place = sent.value[0]
        for b in batches:
            ids = [[place[w] for w in ws if w in place] for ws in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("positive"), pa.array(ids, pa.list_(pa.int32()))], names=["positive", "ids"])

    def fit(batches):
        place, scale = sent.value
        rows = [(p, ids) for b in batches for p, ids in zip(b.column("positive").to_pylist(), b.column("ids").to_pylist())]
        if not rows:
            return
        positive, unlabelled = [x for p, x in rows if p], [x for p, x in rows if not p]
        weight, bias = fit_nnpu(positive, unlabelled, scale, prior, steps=best_steps(positive, unlabelled, scale, prior))
        cols = [pa.array([None, *place], pa.string()), pa.array([bias, *weight], pa.float64())]
        yield pa.RecordBatch.from_arrays(cols, names=["word", "weight"])

    indexed = sample.mapInArrow(index, "positive boolean, ids array<int>")
    # the bounded sample in one task
    return indexed.coalesce(1).mapInArrow(fit, "word string, weight double")


class Sample:
    """Word numbers of some texts, for scoring all at once."""

    def __init__(self, texts: list):
        size = np.array([len(d) for d in texts], np.int64)
        self.n = len(texts)
        self.flat = np.fromiter((i for d in texts for i in d), np.int64, int(size.sum()))
        self.doc = np.repeat(np.arange(self.n), size)

    def score(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.doc, weights[self.flat], self.n) + bias

    def gradient(self, per_doc: np.ndarray, scale: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.flat, per_doc[self.doc], len(scale)) * scale, per_doc.sum())


def descend(positive: Sample, unlabelled: Sample, scale: np.ndarray, prior: float, ridge: float = 1e-4, rate: float = 0.1):
    """(weights per word, already times its scale, and bias) after each step
    of Adam on the non-negative risk over the whole sample."""
    w, b = np.zeros(len(scale)), math.log(prior / (1 - prior))
    m, v, step = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1), 0
    while True:
        step += 1
        gp, gu = positive.score(w * scale, b), unlabelled.score(w * scale, b)
        sp, su = 0.5 * (1 + np.tanh(gp / 2)), 0.5 * (1 + np.tanh(gu / 2))
        negative_part = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        grad_neg = unlabelled.gradient(su / unlabelled.n, scale) - prior * positive.gradient(sp / positive.n, scale)
        if negative_part >= 0:
            grad = prior * positive.gradient((sp - 1) / positive.n, scale) + grad_neg
        else:
            grad = -grad_neg
        grad[:-1] += ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        yield w * scale, float(b)


def fit_nnpu(positive: list, unlabelled: list, scale: np.ndarray, prior: float, steps: int = STEPS):
    """Weights per word (already times its scale) and bias after ``steps``."""
    return next(itertools.islice(descend(Sample(positive), Sample(unlabelled), scale, prior), steps - 1, None))


def best_steps(positive: list, unlabelled: list, scale: np.ndarray, prior: float, most: int = STEPS) -> int:
    """The number of steps, a multiple of CHECK, after which the risk of the
    fifth of the sample that is left out is least."""
    if min(len(positive), len(unlabelled)) < 10:
        return most
    learn = [Sample([d for i, d in enumerate(x) if i % 5]) for x in (positive, unlabelled)]
    held = [Sample(x[::5]) for x in (positive, unlabelled)]
    risks = []
    for step, (w, b) in enumerate(itertools.islice(descend(*learn, scale, prior), most), 1):
        if step % CHECK == 0:
            gp, gu = (x.score(w, b) for x in held)
            rest = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            risks.append((prior * np.logaddexp(0, -gp).mean() + max(0.0, rest), step))
    return min(risks)[1]


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` with ``score`` in 0..1 (a column of that name is replaced).
    One scan of whole texts; the model has at most VOCABULARY + 1 rows."""
    rows = {r["word"]: r["weight"] for r in model.collect()}
    sent = docs.sparkSession.sparkContext.broadcast((rows.pop(None, None), rows))
    docs = docs.drop("score")

    def run(batches):
        bias, weights = sent.value
        memo: dict[str, tuple] = {}

        def known(piece: str) -> tuple:
            found = memo.get(piece)
            if found is None:
                if len(memo) >= MEMO:
                    memo.clear()
                found = memo[piece] = tuple(w for w in _LETTERS.findall(piece.lower()) if w in weights)
            return found

        def one(text: str | None) -> float:
            if bias is None:
                return 0.0
            found = {w for piece in set((text or "").split()) for w in known(piece)}
            g = bias + sum(weights[w] for w in sorted(found))
            return 0.5 * (1 + math.tanh(g / 2))

        for b in batches:
            s = pa.array([one(t) for t in b.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, "score"])

    fields = [StructField(f.name, f.dataType) for f in docs.schema]
    return docs.mapInArrow(run, StructType([*fields, StructField("score", DoubleType())]))
