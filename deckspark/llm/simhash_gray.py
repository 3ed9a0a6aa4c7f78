"""Operator 4: SimHash near-duplicates by a Gray-order hierarchical index.

1. Every text's fingerprint: a bit is set where over half of the hashes of
   its word shingles have it.  One scan; only (doc_id, fingerprint) goes on.
2. Distinct fingerprints are dealt to index nodes (``hamming.nodes``): masks
   with shared bit patterns, refined where a node is large.
3. In a node, fingerprints are sorted by Gray rank, which puts those that
   share bits side by side.  Runs of the order become leaves; a leaf, and
   each group of nodes above, keeps the bits on which all below it agree.  A
   search adds up differences against these shared patterns from the top and
   drops a whole group as soon as they exceed the radius.  The node's links
   leave it as a star per connected class, never as all pairs.
4. Connected components over the stars; a document's component is the
   smallest ``doc_id`` in it.

Defined results: null text is an empty text; texts without words have
fingerprint zero and link like any other; rows with equal fingerprints are
one node of the graph, whatever their number; a null ``doc_id`` never names
a component unless the component has no other; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hamming
from .components import components
from .storage import cut_lineage, release

SHINGLE = 3
RADIUS = 3
SEED = 42
LEAF = 32
FANOUT = 8
NODE_LIMIT = 4096

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    # bytes.split() cuts at exactly 0x20 and 0x09-0x0D
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = (digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle))))
    h = np.fromiter(hashes, np.uint64, n)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    return _fingerprints(docs, shingle).select("doc_id", "fp")


def _fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, th, fp); th is a hash of the text, which tells rows with
    equal ids apart."""

    def run(batches):
        release()
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps, pa.int64())], names=["doc_id", "th", "fp"])

    text = F.col("text").cast("string")
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")]
    return docs.select(*cols).mapInArrow(run, "doc_id long, th long, fp long")


def _classes(smallest: DataFrame, radius: int) -> DataFrame:
    """``smallest`` (fp, first), a written table, with the class's ``root``."""
    roots = components(link_stars(smallest.select("fp"), radius), "fp", "root")
    return smallest.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def gray_rank(code: Column) -> Column:
    """Place of a code in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code


def _codes(ranks: np.ndarray) -> np.ndarray:
    r = ranks.view(np.uint64)
    return r ^ (r >> np.uint64(1))


class GrayIndex:
    """Hierarchy over codes in Gray order: levels[0] are leaves."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        starts = np.arange(0, len(codes), LEAF)
        first = codes[starts]
        differ = np.bitwise_or.reduceat(codes ^ np.repeat(first, np.diff(np.append(starts, len(codes)))), starts)
        self.levels = [(~differ, first & ~differ)]
        while len(self.levels[-1][0]) > FANOUT:
            mask, pattern = self.levels[-1]
            s = np.arange(0, len(mask), FANOUT)
            size = np.diff(np.append(s, len(mask)))
            shared = np.bitwise_and.reduceat(mask, s)
            head = np.repeat(pattern[s], size)
            shared &= ~np.bitwise_or.reduceat((pattern ^ head) & np.repeat(shared, size), s)
            self.levels.append((shared, pattern[s] & shared))

    def pairs(self, lo: int, hi: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(i, j), i < j and lo <= i < hi, of codes within the radius."""
        mask, pattern = self.levels[-1]
        q = np.repeat(np.arange(lo, hi), len(mask))
        node = np.tile(np.arange(len(mask)), hi - lo)
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[depth]
            # each level's mask holds its parent's bits, so the count adds up
            near = np.bitwise_count((self.codes[q] ^ pattern[node]) & mask[node]) <= radius
            near &= (node + 1) * (LEAF * FANOUT**depth) > q  # j > i only
            q, node = q[near], node[near]
            width, below = (FANOUT, len(self.levels[depth - 1][0])) if depth else (LEAF, len(self.codes))
            q, node = np.repeat(q, width), (node[:, None] * width + np.arange(width)).ravel()
            inside = node < below
            q, node = q[inside], node[inside]
        near = (node > q) & (hamming.distances(self.codes[q], self.codes[node]) <= radius)
        return q[near], node[near]


def node_classes(ranks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members that are not their class's first, with that first member; the
    classes are those connected by links within the node."""
    codes = _codes(ranks)
    labels = np.arange(len(codes))
    if len(codes) <= LEAF:
        i, j = np.nonzero(np.triu(hamming.distances(codes[:, None], codes[None, :]) <= radius, 1))
        if not len(i):
            return codes[:0], codes[:0]
        hamming.union(labels, i, j)
    else:
        index = GrayIndex(codes)
        for lo in range(0, len(codes), 64):
            hamming.union(labels, *index.pairs(lo, min(lo + 64, len(codes)), radius))
    own = np.flatnonzero(labels != np.arange(len(codes)))
    return codes[own], codes[labels[own]]


def link_stars(distinct: DataFrame, radius: int, limit: int = NODE_LIMIT) -> DataFrame:
    """(fp, root) edges that connect exactly what links within the radius
    connect.  ``distinct`` is a written table of distinct ``fp``."""

    def run(batches):
        for b in batches:
            column = b.column("ranks")
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            found = [node_classes(np.ascontiguousarray(values[s:e]), radius) for s, e in zip(offsets, offsets[1:])]
            if found:
                cols = [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(cols, names=["fp", "root"])

    out = None
    for level in hamming.nodes(distinct, radius, limit):
        lists = level.groupBy("mask", "pattern").agg(F.array_sort(F.collect_list(gray_rank(F.col("fp")))).alias("ranks"))
        stars = lists.where(F.size("ranks") > 1).select("ranks").mapInArrow(run, "fp long, root long")
        out = stars if out is None else out.union(stars)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    fps = cut_lineage(fingerprints(docs, shingle), "fingerprints")
    smallest = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    classes = cut_lineage(_classes(smallest, radius), "classes")
    # the smallest id per class: combined before the shuffle, then read back
    # as a written table, so a very large class is split over tasks
    names = cut_lineage(classes.groupBy("root").agg(F.min("first").alias("component_id")), "class-names")
    named = cut_lineage(classes.join(names, "root").select("fp", "component_id"), "named-fingerprints")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the first one by
    (doc_id, text hash), null ids last.  Of rows that repeat both, one stays.
    A row with neither an id nor a text stays."""
    blank = F.col("doc_id").isNull() & F.col("text").isNull()
    full = docs.where(~blank)
    rows = _fingerprints(full, shingle).groupBy("fp", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "n")
    smallest = cut_lineage(rows.groupBy("fp").agg(F.min(place).alias("first")), "distinct-fingerprints")
    kept = _classes(smallest, radius).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th"), F.col("first.n").alias("__n"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__th"))
    rows = full.join(cut_lineage(kept, "kept-rows"), same)
    repeated = rows.where("__n > 1").dropDuplicates(["__id", "__th"])
    stay = rows.where("__n = 1").unionByName(repeated).drop("__id", "__th", "__n")
    return stay.unionByName(docs.where(blank))
