"""Operator 10: removal of repeated byte strings by sorted suffixes.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
(in any document, the same included) is removed.

1. Anchors: of the ``GRAM``-byte strings in each window of ``length`` bytes,
   the one with the least hash, the first if several.  Equal windows have
   equal anchors at equal places, so two equal windows always meet at an
   anchor.  An anchor's context is what its windows can reach: up to
   ``length - GRAM`` bytes before it and ``length`` bytes from it on.
2. Anchors with equal hash and context are one class with a count (summed
   before the shuffle); a class with a count of two or more is covered as far
   as its context reaches.
3. Where several classes share an anchor, their suffixes from the anchor on,
   and the reversed strings before it, are sorted deep-shallow: multikey
   quicksort to ``SHALLOW`` bytes, then a blind trie for each group that is
   still equal.  Neighbours' common prefixes give how far each class extends
   with each other one, R to the right and L to the left; the pair holds
   equal windows where ``L + R >= length``.  All of a class's windows contain
   the anchor, so the longest qualifying L and R bound one covered run.
4. Covered runs return to the anchors of each class and are merged per
   document.

Strings are judged on the input.  Defined results: a null text is empty;
matches never cross documents; rows that repeat ``doc_id`` and text repeat
each other and are both covered; texts shorter than ``length`` keep all;
null ids are kept; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut_lineage

LENGTH = 400
GRAM = 64  # a power of two, below LENGTH
SHALLOW = 96  # depth of the multikey quicksort
WORD = 8  # bytes compared at once
GROUP = 4096  # classes sorted together
CHUNK = 1 << 22  # windows of one text handled at once

_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hashes of all ``gram``-byte strings, by doubling."""
    h, width, factor = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of all windows, in order."""
    places, hashes, window = [], [], length - gram + 1
    for start in range(0, len(data) - length + 1, CHUNK):
        h = gram_hashes(data[start : start + CHUNK + length - 1], gram)
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
        at = (low & _PLACE).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        places.append(at + start)
        hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, h = np.concatenate(places), np.concatenate(hashes)
    new = np.concatenate([[True], at[1:] != at[:-1]])  # a chunk's first may be the last one's last
    return at[new], h[new]


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _BlindTrie:
    """Patricia trie: a node knows the byte place where its parts differ; a
    search follows these bytes blindly and compares once, at the leaf."""

    def __init__(self, strings: list[bytes], first: int):
        self.s, self.root = strings, first

    def insert(self, i: int) -> None:
        s, text, node = self.s, self.s[i], self.root
        while isinstance(node, list):
            parts = node[1]
            node = parts.get(text[node[0] : node[0] + 1])
            if node is None:
                node = next(iter(parts.values()))
        leaf = node if isinstance(node, int) else node[0]
        depth = common(text, s[leaf])
        if depth == len(text) == len(s[leaf]):
            self._same(leaf, i)
            return
        above, key, node = None, b"", self.root
        while isinstance(node, list) and node[0] < depth:
            above, key = node, text[node[0] : node[0] + 1]
            node = node[1][key]
        if isinstance(node, list) and node[0] == depth:
            node[1][text[depth : depth + 1]] = i
            return
        new = [depth, {text[depth : depth + 1]: i, s[leaf][depth : depth + 1]: node}]
        if above is None:
            self.root = new
        else:
            above[1][key] = new

    def _same(self, leaf: int, i: int) -> None:
        self.equal = getattr(self, "equal", {})
        self.equal.setdefault(leaf, []).append(i)

    def order(self) -> list[int]:
        out, stack, equal = [], [self.root], getattr(self, "equal", {})
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
            else:
                out.append(node)
                out.extend(equal.get(node, ()))
        return out


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Indices of ``strings`` in order; all are equal up to ``depth``."""
    out: list[int] = []
    stack = [(list(range(len(strings))), depth)]
    while stack:
        group, d = stack.pop()
        if len(group) == 1:
            out.append(group[0])
        elif d >= shallow:
            trie = _BlindTrie(strings, group[0])
            for i in group[1:]:
                trie.insert(i)
            out += trie.order()
        else:
            pivot = strings[group[len(group) // 2]][d : d + WORD]
            less, same, more = [], [], []
            for i in group:
                w = strings[i][d : d + WORD]
                (less if w < pivot else same if w == pivot else more).append(i)
            if len(pivot) < WORD:  # these strings end here and are equal
                same, ended = [], same
            else:
                ended = []
            if more:
                stack.append((more, d))
            if same:
                stack.append((same, d + WORD))
            for i in reversed(ended):
                stack.append(([i], d))
            if less:
                stack.append((less, d))
    return out


def _extents(strings: list[bytes], depth: int, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each string, and the common prefixes of neighbours in order."""
    order = deep_shallow(strings, depth, shallow)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, np.array([common(strings[a], strings[b]) for a, b in zip(order, order[1:])], np.int64)


def _row(rank: np.ndarray, lcp: np.ndarray, i: int) -> np.ndarray:
    """Common prefix of string i with every string (its own: -1)."""
    at, out = rank[i], np.empty(len(rank), np.int64)
    out[at] = -1
    if at < len(lcp):
        out[at + 1 :] = np.minimum.accumulate(lcp[at:])
    if at:
        out[:at] = np.minimum.accumulate(lcp[at - 1 :: -1])[::-1]
    return out[rank]


def extend(group: list[tuple[bytes, bytes]], length: int, gram: int) -> list[tuple[int, int]]:
    """For each (before, from) context of an anchor, the longest L and R over
    the others with L + R >= length; (0, 0) if there is none."""
    right = _extents([r for _, r in group], gram, gram + SHALLOW)
    left = _extents([b[::-1] for b, _ in group], 0, SHALLOW)
    out = []
    for i in range(len(group)):
        r, l = _row(*right, i), _row(*left, i)
        hit = (l >= 0) & (l + r >= length)
        out.append((int(l[hit].max()), int(r[hit].max())) if hit.any() else (0, 0))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, th, pos, r, h, ctx): r bytes of context from the anchor on."""
    names = ["doc_id", "th", "pos", "r", "h", "ctx"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, th, text in zip(*(b.column(c).to_pylist() for c in range(3))):
                data = text.encode()
                at, h = anchors(np.frombuffer(data, np.uint8), length, gram)
                places = at.tolist()
                out[0] += [doc_id] * len(places)
                out[1] += [th] * len(places)
                out[2] += places
                out[3] += np.minimum(length, len(data) - at).tolist()
                out[4] += h.view(np.int64).tolist()
                # the length before the anchor tells contexts cut by a
                # document's start from longer ones
                out[5] += [_signed(xxhash.xxh3_64_intdigest(data[max(0, a - length + gram) : a + length], min(a, length - gram))) for a in places]
                if len(out[0]) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                    out = [[] for _ in names]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return _keyed(docs).where(F.octet_length("text") >= length).mapInArrow(run, "doc_id long, th long, pos long, r int, h long, ctx long")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _contexts(docs: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, ctx, before, from): the bytes of each class's first member."""
    places = shared.groupBy(F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th")).agg(
        F.collect_list(F.struct(F.col("first.pos").alias("pos"), "h", "ctx")).alias("wanted")
    )
    places = cut_lineage(places, "wanted-contexts")
    rows = _keyed(docs).join(places, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))).select("text", "wanted")
    names = ["h", "ctx", "before", "from"]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def run(batches):
        for b in batches:
            out = []
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                data = text.encode()
                for w in wanted:
                    a = w["pos"]
                    out.append((w["h"], w["ctx"], data[max(0, a - length + gram) : a], data[a : a + length]))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    # rows that repeat id and text bring the same contexts
    return rows.mapInArrow(run, "h long, ctx long, before binary, from binary").dropDuplicates(["h", "ctx"])


def _sorted_groups(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, ctx, l, r) of the classes that share windows with others.  Groups
    of more than GROUP classes are cut into parts and each pair of parts is
    sorted by itself, so no task holds an unbounded group."""
    sizes = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(sizes.withColumn("parts", F.ceil(F.col("n") / F.lit(GROUP)).cast("int")).drop("n"), "anchor-groups")
    dealt = contexts.join(sizes, "h").withColumn("own", F.pmod(F.xxhash64("ctx"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = dealt.groupBy("h", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    lists = groups.agg(F.collect_list(F.struct("ctx", "before", "from")).alias("group")).where(F.size("group") > 1)

    def run(batches):
        for b in batches:
            out = []
            for h, group in zip(b.column("h").to_pylist(), b.column("group").to_pylist()):
                found = extend([(g["before"], g["from"]) for g in group], length, gram)
                out += [(h, g["ctx"], l, r) for g, (l, r) in zip(group, found) if r]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["h", "ctx", "l", "r"])

    return lists.select("h", "group").mapInArrow(run, "h long, ctx long, l int, r int")


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, th, runs array<struct<lo, hi>>): covered byte ranges, not yet
    merged, of the documents that have any."""
    table = cut_lineage(_anchor_table(docs, length, gram), "anchors")
    classes = table.groupBy("h", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "pos")).alias("first"), F.min("r").alias("r"))
    # classes of an anchor: at least two of them, or two members of one
    classes = cut_lineage(classes, "anchor-classes")
    several = classes.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
    equal = classes.where("n > 1").select("h", "ctx", F.least(F.col("first.pos"), F.lit(length - gram)).cast("int").alias("l"), "r")
    shared = classes.join(cut_lineage(several, "shared-anchors"), "h", "left_semi")
    contexts = cut_lineage(_contexts(docs, shared, length, gram), "contexts")
    reach = equal.union(_sorted_groups(contexts, length, gram)).groupBy("h", "ctx").agg(F.max("l").alias("l"), F.max("r").alias("reach"))
    covered = table.join(cut_lineage(reach, "reach"), ["h", "ctx"])
    run = F.struct((F.col("pos") - F.col("l")).alias("lo"), (F.col("pos") + F.col("reach")).alias("hi"))
    return covered.groupBy("doc_id", "th").agg(F.collect_set(run).alias("runs"))


def merged(runs: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs, in order; runs that touch are one."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, runs, kept binary) of every row: the removed runs
    and the bytes that stay."""
    schema = "doc_id long, n_bytes long, runs array<struct<lo: long, hi: long>>, kept binary"
    pair = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out = []
                for doc_id, text, runs in zip(*(b.column(c).slice(at, 256).to_pylist() for c in range(3))):
                    data, cut = text.encode(), merged(runs or [])
                    ends = [0, *(x for r in cut for x in r), len(data)]
                    kept = b"".join(data[s:e] for s, e in zip(ends[::2], ends[1::2]))
                    out.append((doc_id, len(data), [{"lo": s, "hi": e} for s, e in cut], kept))
                kinds = (pa.int64(), pa.int64(), pair, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "n_bytes", "runs", "kept"])

    runs = cut_lineage(repeated_runs(docs, length, gram), "runs").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))
    return _keyed(docs).join(runs, same, "left").select("doc_id", "text", "runs").mapInArrow(run, schema)


def removed_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: bytes, removed bytes and runs, digest of what stays."""
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["hi"] - r["lo"])
    return remove_repeats(docs, length, gram).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


