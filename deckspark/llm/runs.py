"""Operator 12: periodic runs of words, by maximal pairs.

A run is a stretch of words with smallest period q and a length of at least
``least`` words and ``times`` periods that no neighbouring word extends.  Its
start s and s + q form a maximal pair: the suffixes there agree in
(length - q) words and the words before them differ.  So every run is a
maximal pair whose distance d and common length l satisfy l + d >= ``least``
and l >= (``times`` - 1) * d, and every such pair spans a run; pairs at a
multiple of the period span the same words and yield to the smallest.

Maximal pairs come from the tree of LCP intervals, built bottom-up over the
suffix array of each text.  A node lists its positions in ascending order,
each with its left-word class (the word before it); where two children meet,
a pair of different classes is proposed if its distance suits the node's
common length.  No third position of the node can lie between the two of a
run's pair (the text there would have two periods, hence by Fine and Wilf a
shorter one), so a position of the smaller child meets only its two
neighbours in the larger one, and a text of one repeated word costs no more
than another.

Texts are handled some at a time by numpy in tasks, without a shuffle: suffix
arrays by prefix doubling, common lengths by descent through the doubled
ranks.  A pair needs a common length of ``times - 1`` periods and ``least``
words in all; texts without a repeated stretch of so many words have no run
and skip the sort.

Defined results: null and empty texts, and texts of white space, have no
words and no run, and collapse to the empty text; texts are read whole, and
the memory of a task grows with its longest text (some 300 bytes a word);
repeated rows and null ids each give their row; an empty table gives no rows;
columns besides the chosen id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

LEAST = 24
TIMES = 3
CHUNK = 400_000  # words handled at a time, and the words of one text beyond it

RUNS = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


def least_common(least: int, times: int) -> int:
    """The least common length of a run's pair: that of any period q is
    max(least - q, (times - 1) * q)."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def word_ids(words: list[bytes], base: int) -> np.ndarray:
    """Each word as ``base`` plus the place of its first occurrence."""
    first = dict(zip(reversed(words), range(base + len(words) - 1, base - 1, -1)))
    return np.fromiter(map(first.__getitem__, words), np.int64, len(words))


def repeated(w: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Which positions start a stretch of ``length`` words (rounded down to a
    power of two) that the same text holds elsewhere, too."""
    n, at, h = len(w), np.arange(len(w)), 1
    rank, alive = w, np.bincount(w, minlength=n)[w] > 1
    while 2 * h <= length:
        here = np.flatnonzero(alive[: n - h] & alive[h:] & (at[: n - h] + h < end[: n - h])) if n > h else at[:0]
        _, same, count = np.unique(rank[here] * n + rank[here + h], return_inverse=True, return_counts=True)
        rank, alive = np.full(n, -1), np.zeros(n, bool)
        rank[here], alive[here] = same, count[same] > 1
        h *= 2
    return alive


def suffix_array(w: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common length of each with the next) by prefix
    doubling.  Texts share no word id, so their suffixes never mix.  A rank
    is the place of the first suffix that is equal so far."""
    n = len(w)
    order = np.argsort(w, kind="stable")
    new = np.concatenate([[True], w[order][1:] != w[order][:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [], 1
    while True:
        levels.append(np.append(rank, np.int32(-1)))
        size = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(size[rank] > 1)
        if not len(open_):
            break
        nxt = np.where(open_ + h < end[open_], rank[np.minimum(open_ + h, n - 1)].astype(np.int64) + 1, 0)
        key = rank[open_].astype(np.int64) * (n + 1) + nxt
        by = np.argsort(key, kind="stable")
        key, who = key[by], open_[by]
        group = rank[who]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        nth = np.arange(len(who)) - np.maximum.accumulate(np.where(first, np.arange(len(who)), 0))
        place = group + nth
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[who] = np.maximum.accumulate(np.where(fresh, place, 0))
        h *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = (levels[k][np.minimum(a, n)] == levels[k][np.minimum(b, n)]) & (a < n) & (b < n)
        step = np.where(same, 1 << k, 0)
        a, b, common = a + step, b + step, common + step
    return sa, common


def maximal_pairs(sa: list[int], common: list[int], left, least: int, times: int):
    """(start, distance, common length) of the pairs that span runs, over a
    stretch of the suffix array whose suffixes agree in the words that any
    pair needs.  The stack holds the open LCP intervals: [common length,
    positions in ascending order]."""
    found: list[tuple[int, int, int]] = []

    def meet(node: list, child: list[int]) -> None:
        l, big = node
        small = child
        if len(small) > len(big):
            big, small = small, big
        low, high = max(1, least - l), l // (times - 1)
        for x in small:
            at = bisect_left(big, x)
            if at < len(big) and low <= big[at] - x <= high and left[big[at]] != left[x]:
                found.append((x, big[at] - x, l))
            if at and low <= x - big[at - 1] <= high and left[big[at - 1]] != left[x]:
                found.append((big[at - 1], x - big[at - 1], l))
        if len(small) * 64 < len(big):
            for x in small:
                insort(big, x)
        else:
            big.extend(small)
            big.sort()
        node[1] = big

    stack: list[list] = []
    for p, l in zip(sa, [*common, 0]):
        child = [p]
        while stack and stack[-1][0] > l:
            meet(stack[-1], child)
            child = stack.pop()[1]
        if stack and stack[-1][0] == l:
            meet(stack[-1], child)
        elif l:
            stack.append([l, child])
    return found


def find_runs(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of every run of each list of words, by
    start, then period."""
    need = least_common(least, times)
    sizes = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(sizes)
    w = np.concatenate([np.zeros(0, np.int64), *[word_ids(t, int(e) - len(t)) for t, e in zip(texts, stop)]])
    end = np.repeat(stop, sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    some = repeated(w, end, need)
    keep = np.unique(np.searchsorted(stop, np.flatnonzero(some), side="right"))
    if not len(keep):
        return out
    # only texts with a repeated stretch are sorted, under new places
    starts = stop - sizes
    take = np.concatenate([np.arange(starts[k], stop[k]) for k in keep])
    new_stop = np.cumsum(sizes[keep])
    new_start = new_stop - sizes[keep]
    shift = np.repeat(starts[keep] - new_start, sizes[keep])
    w, end = w[take] - shift, np.repeat(new_stop, sizes[keep])
    begin = np.repeat(new_start, sizes[keep])
    sa, common = suffix_array(w, end)
    at = np.arange(len(w))
    left = np.where(at > begin, w[at - 1], -1 - at)
    deep = np.concatenate([[0], (common >= need).astype(np.int8), [0]])
    first, last = np.flatnonzero(np.diff(deep) == 1), np.flatnonzero(np.diff(deep) == -1)
    left = left.tolist()
    spans: dict[tuple[int, int], int] = {}
    for i, j in zip(first, last):
        for s, d, l in maximal_pairs(sa[i : j + 1].tolist(), common[i:j].tolist(), left, least, times):
            span = (s, l + d)
            spans[span] = min(d, spans.get(span, d))
    for (s, length), d in spans.items():
        k = int(np.searchsorted(new_stop, s, side="right"))
        out[keep[k]].append((s - int(new_start[k]), length, d))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if found:
        change = np.zeros(len(words) + 1, np.int64)
        for s, length, q in found:
            change[s + q] += 1
            change[s + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(id, runs, collapsed) for every row of ``docs``: its runs by start,
    then period, with starts as word numbers from 0, and its text without the
    repetitions.  ``times`` is at least 3 (two neighbours are enough from
    there on)."""
    if times < 3:
        raise ValueError("runs of fewer than three periods need all pairs of a node")

    def run(batches):
        for b in batches:
            texts = b.column("__text").to_pylist()
            at = 0
            while at < len(texts):
                some, total, stop = [], 0, at
                while stop < len(texts) and (total < CHUNK or not some):
                    some.append((texts[stop] or "").encode().split())  # the ASCII white space of the contract
                    total += len(some[-1])
                    stop += 1
                found = find_runs(some, least, times)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                short = pa.array([collapse(t, f).decode() for t, f in zip(some, found)], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, stop - at), pa.array(rows, kind), short], names=[id_col, "runs", "collapsed"])
                at = stop

    only = docs.select(id_col, F.col(text).cast("string").alias("__text"))
    more = StructType.fromDDL(RUNS).fields
    return only.mapInArrow(run, StructType([StructField(id_col, only.schema[id_col].dataType), *more]))
