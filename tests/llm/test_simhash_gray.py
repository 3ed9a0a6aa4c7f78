import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from deckspark.llm import hamming
from deckspark.llm.components import components
from deckspark.llm.simhash_gray import GrayIndex, fingerprint, fingerprints, gray_rank, keep_one, link_stars, near_duplicates, node_classes
from deckspark.llm.storage import cut_lineage

from .conftest import prose


def slow_fingerprint(text):
    """From the definition, bit by bit."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """value -> smallest reachable value by comparing all pairs."""
    near = {a: [b for b in fps if (a ^ b).bit_count() <= 3] for a in fps}
    out = {}
    for a in sorted(fps):
        stack = [a]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = a
                stack += near[x]
    return out


def clustered(rnd, n):
    out = set()
    while len(out) < n:
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 2, 30])):
            out.add(x)
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
    return sorted(out)[:n]


def test_fingerprints(edge_rows):
    for _, text, _ in edge_rows:
        assert fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


def test_spark_gray_rank(spark):
    df = spark.range(-50, 50).select("id", gray_rank(F.col("id")).alias("r"))
    for i, r in df.collect():
        r &= (1 << 64) - 1
        assert r ^ r >> 1 == i & (1 << 64) - 1


def test_index_finds_all_pairs():
    rnd = random.Random(1)
    codes = np.array(clustered(rnd, 700), np.uint64)
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    index = GrayIndex(codes)
    got = {(int(i), int(j)) for lo in range(0, 700, 64) for i, j in zip(*index.pairs(lo, min(lo + 64, 700), 3))}
    i, j = np.nonzero(np.triu(hamming.distances(codes[:, None], codes[None, :]) <= 3, 1))
    assert got == set(zip(i.tolist(), j.tolist()))
    moved, first = node_classes(np.sort(rank).view(np.int64), 3)
    want = classes([int(c) for c in codes])
    assert len(moved) == len(codes) - len(set(want.values()))
    assert all(want[int(a)] == want[int(b)] for a, b in zip(moved, first))


def test_links_connect_what_all_pairs_connect(spark):
    """With a small node limit, so that large nodes are refined."""
    fps = clustered(random.Random(2), 500)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = cut_lineage(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = {r.node: r.root for r in components(link_stars(table, 3, limit=16), "fp", "root").collect()}
    want = classes(fps)
    got = {}
    for x, s in zip(fps, signed):
        got.setdefault(roots.get(s, s), set()).add(want[x])
    assert all(len(v) == 1 for v in got.values()) and len(got) == len(set(want.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert len(got) == 301 + 400
    assert len({got[i] for i in range(301)}) == 1 and len({got[i] for i in range(1000, 1400)}) == 1
    assert got[0] != got[1000]


def test_edge_cases(edge_docs, edge_rows, no_docs):
    want = classes({slow_fingerprint(t) for _, t, _ in edge_rows})
    smallest = {}
    for i, t, _ in edge_rows:
        if i is not None:
            k = want[slow_fingerprint(t)]
            smallest[k] = min(i, smallest.get(k, i))
    expect = sorted((str(i), slow_fingerprint(t), str(smallest.get(want[slow_fingerprint(t)]))) for i, t, _ in edge_rows)
    got = sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in near_duplicates(edge_docs).collect())
    assert got == expect
    assert near_duplicates(no_docs).count() == 0 and fingerprints(no_docs).count() == 0


def test_one_of_each_group_stays(edge_docs, no_docs):
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    names = {r.component_id for r in near_duplicates(edge_docs.where("doc_id is not null")).collect()}
    assert ids == sorted([*(str(x) for x in names), "None", "None"])
    assert keep_one(no_docs).count() == 0


def test_rows_that_share_an_id_or_have_none(spark, docs_table):
    """Each group keeps one row, and no unrelated text goes."""
    rnd = random.Random(12)
    a, b, c, d, e = (prose(rnd, 80) for _ in range(5))
    rows = [(2, a, "en"), (2, b, "en"), (2, b, "en"), (3, c, "en"), (4, c.upper(), "en"), (4, d, "en")]
    rows += [(None, a, "en"), (None, e, "en"), (None, e, "en"), (None, e.upper(), "en")]
    kept = sorted(((str(r.doc_id), r.text.lower()) for r in keep_one(docs_table(rows).repartition(3)).collect()), key=str)
    assert kept == sorted([("2", a), ("2", b), ("3", c), ("4", d), ("None", e)], key=str)
