"""Operator 2: fuzzy line dedup over all documents.

1. Lines are normalised (lower case, digits as 0, white space collapsed) and
   fingerprinted by SimHash over their different words.  One scan leaves
   (document, line number, line hash, fingerprint).
2. Distinct fingerprints meet in pigeonhole blocks (``hamming.nodes``); those
   with another within ``radius`` bits keep the nodes where they met.
3. Only lines with such a fingerprint, or one that several different lines
   share, bring their text to those nodes.  There, pairs within the radius
   are verified by edit similarity, skipping pairs that are connected
   already; a node yields a star per class.
4. Connected components over the verified stars; of each group of equal or
   linked lines the first occurrence stays, by (doc_id, text hash, line).

Defined results: a line without a letter or digit is never removed; the
other lines of a text keep their order and form; a text that loses all its
lines becomes empty; a null text stays null; null ids sort first; rows that
repeat both ``doc_id`` and text are one document and keep the same lines;
an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import hamming
from .components import components
from .storage import cut_lineage, release

RADIUS = 3
SIMILARITY = 0.8
FP_LIMIT = 2048  # distinct fingerprints of a node
TEXT_LIMIT = 512  # lines verified together

_DIGIT = re.compile(r"\d")
_HIGH = re.compile("[\u0660-\U0010ffff]")  # from the first digit that is not ASCII on
_RUNS = re.compile(r"[^\W_]+")
_OTHER = re.compile(r"[^\w\n]+|_+")
ROWS = 512  # rows of a batch that are texts in Python at a time


def _folded(text: str) -> str:
    """Lower case, digits as 0."""
    text = text.lower()
    if not text.isascii() and _HIGH.search(text):
        return _DIGIT.sub("0", text)
    for digit in "123456789":
        text = text.replace(digit, "0")
    return text


def normalise(line: str) -> str:
    return " ".join(_folded(line).split())


def _word_hashes(words: list[str]) -> np.ndarray:
    """Hash of each word's letters and digits, 0 without any."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    odd = [i for i, w in enumerate(words) if not w.isalnum()]
    bare = _OTHER.sub("", "\n".join([words[i] for i in odd])).split("\n")
    h[odd] = [xxhash.xxh64_intdigest(w) if w else 0 for w in bare[: len(odd)]]
    return h


def line_fingerprints(lines: list[str]) -> np.ndarray:
    """SimHash of each normalised line's different words (punctuation
    aside), as signed integers."""
    out = np.zeros(len(lines), np.uint64)
    if not lines:
        return out.view(np.int64)
    cut = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
    coded = cut.values.dictionary_encode()
    hashes = _word_hashes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    # a word's repeats within its line count once
    own = np.repeat(np.arange(len(lines)), np.diff(cut.offsets.to_numpy()))
    key = np.sort(own << 32 | coded.indices.to_numpy())
    key = key[np.append(True, key[1:] != key[:-1])]
    h, own = hashes[key & 0xFFFFFFFF], key >> 32
    h, own = h[h != 0], own[h != 0]
    sizes = np.bincount(own, minlength=len(lines))
    ends = np.append(0, np.cumsum(sizes))
    first = 0
    while first < len(lines):  # about 100,000 words at a time
        last = min(len(lines), max(first + 1, int(np.searchsorted(ends, ends[first] + 100_000))))
        some = np.flatnonzero(sizes[first:last]) + first
        if len(some):
            out[some] = _majorities(h[ends[first] : ends[last]], ends[some] - ends[first], sizes[some])
        first = last
    return out.view(np.int64)


def _majorities(h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits set in more than half of the hashes of each run of ``h``.
    Eight bytes are added at once: a byte counts 255 words at most, so longer
    runs are counted in parts."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    parts = -(-size // 255)
    begin = np.cumsum(parts) - parts
    places = np.repeat(start, parts) + 255 * (np.arange(parts.sum()) - np.repeat(begin, parts))
    counts = np.add.reduceat(bits.view(np.uint64), places, axis=0).view(np.uint8)
    counts = np.add.reduceat(counts, begin, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > size[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _equal_run(a: str, i: int, b: str, j: int) -> int:
    """Length of the common prefix of a[i:] and b[j:], by growing slices."""
    n, got, step = min(len(a) - i, len(b) - j), 0, 16
    while got < n:
        s = min(step, n - got)
        if a[i + got : i + got + s] == b[j + got : j + got + s]:
            got += s
            step *= 2
        elif s == 1:
            break
        else:
            step = s // 2
            n = got + s - 1  # the difference lies within
            while step and got < n:
                if a[i + got : i + got + step] == b[j + got : j + got + step]:
                    got += step
                    step = min(step, n - got)
                else:
                    n = got + step - 1
                    step //= 2
            break
    return got


def _by_diagonals(a: str, b: str, most: int) -> int | None:
    """Distance, if at most ``most``: the furthest point on each diagonal
    that e edits reach, for e = 0, 1, ...; cheap for nearly equal strings."""
    goal, reach = len(b) - len(a), {0: _equal_run(a, 0, b, 0)}
    for e in range(most + 1):
        if reach.get(goal, -1) >= len(a):
            return e
        new = {}
        for k in range(-e - 1, e + 2):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -1), reach.get(k + 1, -2) + 1)
            i = min(i, len(a), len(b) - k)
            if i >= 0 and i + k >= 0:
                new[k] = i + _equal_run(a, i, b, i + k)
        reach = new
    return None


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most + 1`` if it is larger.  Equal ends are
    cut off first.  Long strings are tried by diagonals up to the distance
    where Myers' bit-vector method on long integers, which does the rest,
    takes less time."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    lo = _equal_run(a, 0, b, 0)
    a, b = a[lo:][::-1], b[lo:][::-1]
    hi = _equal_run(a, 0, b, 0)
    a, b = a[hi:], b[hi:]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    if len(a) > 500:
        few = min(most, 8 + math.isqrt(len(a) * (40_000 + len(a)) // 100_000))
        found = _by_diagonals(a, b, few)
        if found is not None or few == most:
            return most + 1 if found is None else found
    return _by_bits(a, b, most)


def _by_bits(a: str, b: str, most: int) -> int:
    m, places = len(a), {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    for k, c in enumerate(b):
        eq = places.get(c, 0)
        x = eq | down
        eq |= ((eq & up) + up) ^ up
        ph, mh = down | ~(eq | up) & ones, up & eq
        score += 1 if ph & top else -1 if mh & top else 0
        if score - (len(b) - 1 - k) > most:
            return most + 1
        ph, mh = (ph << 1 | 1) & ones, mh << 1 & ones
        up, down = mh | ~(x | ph) & ones, ph & x
    return score


def _bound(a: str, b: str) -> int:
    """At least the distance: words that both strings hold just once and in
    the same order stay, and so do equal ends between two of them; the rest
    between them is replaced as a whole."""
    x, y = a.split(" "), b.split(" ")
    once: list[dict[str, int]] = []
    for words in (x, y):
        at: dict[str, int] = {}
        for i, w in enumerate(words):
            at[w] = -1 if w in at else i
        once.append(at)
    pairs = [(i, j) for w, i in once[0].items() if i >= 0 and (j := once[1].get(w, -1)) >= 0]
    # longest increasing run of places in b: the last pair of each length
    tails: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(tails, j)
        tails[n : n + 1], last[n : n + 1] = [j], [k]
        back.append(last[n - 1] if n else -1)
    stay, k = [(len(x), len(y))], last[-1] if last else -1
    while k >= 0:
        stay.append(pairs[k])
        k = back[k]
    total = i = j = 0
    for k, m in reversed(stay):
        hi, hj = k, m
        while i < hi and j < hj and x[i] == y[j]:
            i, j = i + 1, j + 1
        while i < hi and j < hj and x[hi - 1] == y[hj - 1]:
            hi, hj = hi - 1, hj - 1
        # each word with a space
        total += max(sum(map(len, x[i:hi])) + hi - i, sum(map(len, y[j:hj])) + hj - j)
        i, j = k + 1, m + 1
    return total


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Is 1 - distance / longer length at least ``least``?"""
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    return _bound(a, b) <= most or edit_distance(a, b, most) <= most


def _slices(batches):
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, lh, fp) of every line that can be a duplicate; th is
    a hash of the whole text, which tells rows with equal ids apart."""
    schema = "doc_id long, th long, pos int, lh binary, fp long"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())

    def batch(places: list[tuple], found: list[str]) -> pa.RecordBatch:
        cols = [*zip(*places), list(map(xxhash.xxh3_128_digest, found)), line_fingerprints(found)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def run(batches):
        release()
        for b in _slices(batches):
            places: list[tuple] = []
            found: list[str] = []
            for doc_id, th, text in zip(*(b.column(c).to_pylist() for c in range(3))):
                # lower case and digits of a whole text at once, as by line
                for pos, line in enumerate(_folded(text).split("\n")):
                    if _RUNS.search(line):
                        places.append((doc_id, th, pos))
                        found.append(" ".join(line.split()))
                if len(found) >= 5000:
                    yield batch(places, found)
                    places, found = [], []
            if found:
                yield batch(places, found)

    return _keyed(docs).where("text is not null").mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _meetings(distinct: DataFrame) -> DataFrame:
    """(mask, pattern, fp): the nodes in which a fingerprint has another
    within the radius."""

    def run(batches):
        for b in batches:
            out = []
            for mask, pattern, fps in zip(*(b.column(c).to_pylist() for c in range(3))):
                x = np.array(fps, np.int64).view(np.uint64)
                near = np.zeros(len(x), bool)
                for at in range(0, len(x), 256):
                    d = hamming.distances(x[at : at + 256, None], x[None, :]) <= RADIUS
                    near[at : at + 256] = d.sum(axis=1) > 1
                out += [(mask, pattern, fps[i]) for i in np.flatnonzero(near)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["mask", "pattern", "fp"])

    met = None
    for level in hamming.nodes(distinct, RADIUS, FP_LIMIT):
        lists = level.groupBy("mask", "pattern").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        part = lists.mapInArrow(run, "mask long, pattern long, fp long")
        met = part if met is None else met.union(part)
    return met


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lh, fp, line): the normalised lines of ``wanted`` (lh, fp, first)."""
    places = wanted.groupBy(F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th")).agg(
        F.collect_list(F.struct(F.col("first.pos").alias("pos"), "lh", "fp")).alias("wanted")
    )
    rows = _keyed(docs).join(places, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))

    def run(batches):
        for b in _slices(batches):
            out = []
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                cut = text.split("\n")
                out += [(w["lh"], w["fp"], normalise(cut[w["pos"]])) for w in wanted]
            cols = list(zip(*out)) or [(), (), ()]
            kinds = (pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["lh", "fp", "line"])

    return rows.select("text", "wanted").mapInArrow(run, "lh binary, fp long, line string").distinct()


def _verified(members: DataFrame) -> DataFrame:
    """(lh, root) stars of the lines that a node's verified links connect.
    ``members`` (mask, pattern, lh, fp, line) is a written table.  A node
    with more than TEXT_LIMIT lines is cut into parts, and each pair of parts
    is verified by itself, so no task holds an unbounded node.  A pair that
    meets in several nodes of the first level is verified in the first."""
    roots = np.array(hamming.child_masks(0, RADIUS), np.int64).view(np.uint64)
    sizes = members.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = cut_lineage(sizes.withColumn("parts", F.ceil(F.col("n") / F.lit(TEXT_LIMIT)).cast("int")), "node-sizes")
    dealt = members.join(sizes.select("mask", "pattern", "parts"), ["mask", "pattern"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("lh"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.groupBy("mask", "pattern", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    groups = dealt.agg(F.collect_list(F.struct("lh", "fp", "line")).alias("lines")).where(F.size("lines") > 1)

    def earlier(mask: int) -> np.ndarray:
        """Blocks of which a pair that agrees is verified elsewhere: those
        before the node's own, if the node is of the first level."""
        at = np.flatnonzero(roots.view(np.int64) == mask)
        return roots[: at[0]] if len(at) else roots[:0]

    def run(batches):
        for b in batches:
            out = []
            for mask, group in zip(b.column("mask").to_pylist(), b.column("lines").to_pylist()):
                group.sort(key=lambda x: x["lh"])
                x = np.array([g["fp"] for g in group], np.int64).view(np.uint64)
                before = earlier(mask)
                labels = np.arange(len(group))
                for i in range(len(group) - 1):
                    differ = x[i] ^ x[i + 1 :]
                    near = np.bitwise_count(differ) <= RADIUS
                    if mask != -1:  # equal ones meet in the node of all bits
                        near &= differ != 0
                    for block in before:
                        near &= differ & block != 0
                    for j in i + 1 + np.flatnonzero(near):
                        if labels[i] != labels[j] and similar(group[i]["line"], group[j]["line"]):
                            labels[labels == max(labels[i], labels[j])] = min(labels[i], labels[j])
                out += [(group[i]["lh"], group[labels[i]]["lh"]) for i in np.flatnonzero(labels != np.arange(len(group)))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["lh", "root"])

    return groups.select("mask", "lines").mapInArrow(run, "lh binary, root binary")


def line_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables: occurrences (doc_id, th, pos, lh, fp) and, of every
    different line, (lh, n, first, class_id): class_id is the line hash that
    stands for all lines it is linked with."""
    occurrences = cut_lineage(lines(docs), "lines")
    different = occurrences.groupBy("lh").agg(F.min(F.struct("doc_id", "th", "pos")).alias("first"), F.count(F.lit(1)).alias("n"), F.min("fp").alias("fp"))
    different = cut_lineage(different, "different-lines")
    per_fp = cut_lineage(different.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "line-fingerprints")
    same = per_fp.where("n > 1").select(F.lit(-1).cast("long").alias("mask"), F.col("fp").alias("pattern"), "fp")
    met = cut_lineage(_meetings(per_fp.select("fp")).union(same), "meetings")
    wanted = different.join(met.select("fp").distinct(), "fp", "left_semi")
    texts = cut_lineage(_texts(docs, wanted), "linked-lines")
    members = cut_lineage(met.join(texts, "fp"), "node-members")
    roots = components(_verified(members), "lh", "root")
    classes = different.select("lh", "n", "first").join(roots.withColumnRenamed("node", "lh"), "lh", "left")
    return occurrences, cut_lineage(classes.withColumn("class_id", F.coalesce("root", "lh")).drop("root"), "line-classes")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, removed array<int>): the lines to remove per document."""
    occurrences, classes = line_classes(docs)
    keepers = classes.groupBy("class_id").agg(F.min("first").alias("keeper"), F.sum("n").alias("total")).where("total > 1")
    keepers = cut_lineage(keepers.drop("total"), "keepers")
    repeated = cut_lineage(classes.join(keepers, "class_id").select("lh", "keeper"), "repeated-lines")
    here = F.struct("doc_id", "th", "pos")
    gone = occurrences.select("doc_id", "th", "pos", "lh").join(repeated, "lh").where(~here.eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines removed from ``text``, and their number in
    ``n_lines_removed`` (long; a column of that name is replaced)."""
    docs = docs.drop("n_lines_removed")
    gone = removed_lines(docs).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "removed")
    gone = cut_lineage(gone.withColumnRenamed("removed", "__gone"), "removed-lines")
    key = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__th"))
    rows, names = docs.join(gone, key, "left"), [*docs.columns, "n_lines_removed"]

    def cut(texts, removed):
        for t, r in zip(texts, removed):
            if r is None or t is None:
                yield t
            else:
                r = set(r)
                yield "\n".join(x for i, x in enumerate(t.split("\n")) if i not in r)

    def run(batches):
        for b in _slices(batches):
            i = b.schema.get_field_index("text")
            new = pa.array(cut(b.column(i).to_pylist(), b.column("__gone").to_pylist()), pa.string())
            n = pa.array([len(r or ()) for r in b.column("__gone").to_pylist()], pa.int64())
            b = b.set_column(i, "text", new).set_column(b.schema.get_field_index("__gone"), "n_lines_removed", n)
            yield b.select(names)

    fields = [StructField(f.name, StringType() if f.name == "text" else f.dataType) for f in docs.schema]
    return rows.drop("__id", "__th").mapInArrow(run, StructType([*fields, StructField("n_lines_removed", LongType())]))
