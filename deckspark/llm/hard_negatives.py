"""Operator 13: hard negatives by a vertical scan of vector blocks (BOND).

Vectors are dealt to blocks that hold each dimension as a column.  For an
anchor, a task reads a block's columns in descending order of the anchor's
component magnitudes.  The block's minima and maxima of the columns still
unread bound what they can add to a row's score; a bitmap of candidate rows
shrinks as bounds rule rows out, and what is left when all columns are read
has exact scores.

Two scans: the first finds each anchor's positives (its best other rows of the
same label); a row goes once as many rows as wanted are surely better.  The
second finds, for each positive, the best rows of other labels whose score
lies in a window below the positive's; a row goes once it cannot lie in any of
the anchor's windows, or cannot be among the first of those it may lie in.
Scores are whole numbers, so windows resolve exactly.

The anchors are a stated share of the rows and meet all rows, block by block:
a pair of a block of rows and a block of anchors is one group of a co-grouped
map, so the memory of a task is that of two blocks.  A block yields at most as
many rows per anchor (and positive) as the result shows.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; vectors meet only vectors of their own
length (empty vectors have score 0); equal rows (id, label, vector) count
once; rows that share an id and differ are all candidates, never for their
own id, and the anchor of such an id is the first by label, then vector; ties
go to the smaller id; a window of a negative positive score is empty;
components beyond 64 bits after scaling saturate, and so do scores; anchors
without a positive or without a negative in the window give no rows; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut_lineage

POSITIVES, NEGATIVES = 5, 5
WINDOW = (80, 100)  # percent of the positive's score, both ends included
BLOCK_BYTES = 32 << 20  # of a block's 64-bit components
LEAST_ROWS = 2048  # a block is not split for more tasks below this
STEP = 8  # columns read between two prunings
LONG = 2**63 - 1


class Block:
    """Columns of the rows of one block, in ascending order of ids."""

    def __init__(self, table: pa.Table, dim: int):
        table = table.combine_chunks()
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], table.column("label").to_numpy()[order]
        self.columns = np.ascontiguousarray(matrix(table, dim)[order].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.most = int(max(abs(int(x)) for x in (*self.low, *self.high))) if dim else 0

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of the rows that ``keep`` (a test of lower
        and upper bounds) leaves of those in ``bitmap``."""
        columns, low, high, a = self.columns, self.low, self.high, anchor
        if a.size and int(np.abs(a.astype(object)).max()) * self.most * a.size >= 2**62:
            columns, low, high, a = columns.astype(object), low.astype(object), high.astype(object), a.astype(object)
        order = np.argsort(-np.abs(a), kind="stable")
        ends = np.sort([a[order] * low[order], a[order] * high[order]], axis=0)
        zero = np.zeros((2, 1), ends.dtype)
        rest_low, rest_high = np.hstack([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], zero])
        at = np.flatnonzero(bitmap)
        score = np.zeros(len(at), columns.dtype)
        for k in range(0, len(order), STEP):
            some = order[k : k + STEP]
            score = score + (a[some][:, None] * columns[some][:, at]).sum(axis=0)
            stay = keep(score + rest_low[k + len(some)], score + rest_high[k + len(some)])
            at, score = at[stay], score[stay]
            if not len(at):
                break
        return at, score


def matrix(table: pa.Table, dim: int) -> np.ndarray:
    v = table.column("v").combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, dim)


def at_least(values: np.ndarray, k: int):
    """The k-th largest of ``values``, None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def best_of(block: Block, anchor: np.ndarray, bitmap: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``bitmap``, best first."""

    def keep(low, high):
        bar = at_least(low, k)
        return np.ones(len(low), bool) if bar is None else high >= bar

    at, score = block.scan(anchor, bitmap, keep)
    first = np.argsort(-score, kind="stable")[:k]
    return at[first], score[first]


def best_in_windows(block: Block, anchor: np.ndarray, bitmap: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window of scores, its ``k`` best rows of ``bitmap``."""

    def keep(low, high):
        stay = np.zeros(len(low), bool)
        for a, b in windows:
            may = (high >= a) & (low <= b)
            bar = at_least(low[may & (low >= a) & (high <= b)], k)
            stay |= may if bar is None else may & (high >= bar)
        return stay

    at, score = block.scan(anchor, bitmap, keep)
    order = np.argsort(-score, kind="stable")
    at, score = at[order], score[order]
    for a, b in windows:
        first = np.flatnonzero((score >= a) & (score <= b))[:k]
        yield at[first], score[first]


def windows_of(scores: list[int], window: tuple[int, int]) -> list[tuple[int, int]]:
    """``window`` percent of each score, as whole numbers."""
    low, high = window
    return [(-(-low * s // 100), high * s // 100) for s in scores]


def quantised(vectors: DataFrame, scale: int, id_col: str, label: str, vector: str) -> DataFrame:
    """(vec_id, label, v array<long>, dim) of the distinct rows that take part."""
    v = F.col(vector).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ok)
    whole = F.transform(v, lambda x: F.when(F.abs(x) * scale < 2.0**62, F.floor(x * scale)).otherwise(F.signum(x).cast("long") * LONG))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole.alias("v"), F.size(v).alias("dim")).distinct()


def _blocks(rows: DataFrame) -> int:
    """How many blocks the rows make: as many as there are shuffle
    partitions while these hold enough rows, more where they hold too much."""
    n, values = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0))).first()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(tasks, n // LEAST_ROWS), math.ceil(values * 8 / BLOCK_BYTES))


def _meet(rows: DataFrame, g: int, anchors: DataFrame, a: int, fn, schema: str) -> DataFrame:
    """``fn(block of rows, block of anchors)`` for every pair of blocks of
    vectors of one length."""
    keys = ["dim", "g", "a"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("g", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(g)).cast("int")).withColumn("a", every(a))
    right = anchors.withColumn("a", F.pmod(F.xxhash64("anchor_id"), F.lit(a)).cast("int")).withColumn("g", every(g))
    empty = pa.schema([(f.name, pa.int64()) for f in rows.sparkSession.createDataFrame([], schema).schema]).empty_table()

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return empty
        dim = x.column("dim")[0].as_py()
        found = [r for some in fn(Block(x, dim), y, matrix(y, dim)) for r in some]
        return pa.table({c: pa.array([_long(r[i]) for r in found], pa.int64()) for i, c in enumerate(empty.column_names)})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _long(x) -> int:
    return max(-LONG - 1, min(LONG, int(x)))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = 256,
    id_col: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row that the condition ``anchors`` (on
    ``vec_id``) names and each of its first ``positives`` other rows of the
    same label, the first ``negatives`` rows of other labels whose score is
    within ``window`` percent of the positive's.  Scores are inner products
    of floor(``scale`` * component), higher first."""
    rows = cut_lineage(quantised(vectors, scale, id_col, label, vector), "bond-rows")
    asked = rows.where(anchors).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v", "dim")).alias("x"))
    asked = cut_lineage(asked.select("anchor_id", "x.*"), "bond-anchors")
    g, a = _blocks(rows), max(1, math.ceil(asked.agg(F.coalesce(F.sum("dim"), F.lit(0))).first()[0] * 8 / BLOCK_BYTES))

    def same_label(block: Block, table: pa.Table, vecs: np.ndarray):
        for i, lab, x in zip(table.column("anchor_id").to_pylist(), table.column("label").to_pylist(), vecs):
            at, score = best_of(block, x, (block.labels == lab) & (block.ids != i), positives)
            yield zip([i] * len(at), block.ids[at], score)

    near = _meet(rows, g, asked, a, same_label, "anchor_id long, positive_id long, positive_score long")
    nth = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")).alias("nth")
    near = cut_lineage(near.select("*", nth).where(F.col("nth") <= positives), "bond-positives")
    # at most `positives` to an anchor
    pairs = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("p"))
    paired = cut_lineage(asked.join(pairs, "anchor_id").select("*", "p.positive_id", "p.positive_score").drop("p"), "bond-pairs")

    def other_label(block: Block, table: pa.Table, vecs: np.ndarray):
        cols = [table.column(c).to_pylist() for c in ("anchor_id", "label", "positive_id", "positive_score")]
        for i, lab, ids, scores, x in zip(*cols, vecs):
            found = best_in_windows(block, x, (block.labels != lab) & (block.ids != i), windows_of(scores, window), negatives)
            for nth, (pid, ps, (at, score)) in enumerate(zip(ids, scores, found)):
                n = len(at)
                yield zip([i] * n, [nth] * n, [pid] * n, [ps] * n, block.ids[at], score)

    schema = "anchor_id long, nth long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _meet(rows, g, paired, a, other_label, schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "nth").orderBy(F.col("negative_score").desc(), "negative_id")).alias("rank")
    out = far.select("*", rank).where(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
