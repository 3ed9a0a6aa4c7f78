import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from deckspark.llm import suffix_dedup as S

from .conftest import prose


def by_hand(texts, length):
    """Removed runs by counting all strings of the length."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = bytearray(len(d) + 1)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mark[i : i + length] = b"\x01" * length
        edge = [i for i in range(len(mark)) if mark[i] != (mark[i - 1] if i else 0)]
        runs = list(zip(edge[::2], edge[1::2]))
        kept = bytes(c for c, m in zip(d, mark) if not m)
        out.append((len(d), sum(mark), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


def test_deep_shallow_order():
    rnd = random.Random(3)
    for _ in range(200):
        s = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(1, 40))]
        s += [rnd.choice(s) + bytes(rnd.choice(b"ab") for _ in range(3)) for _ in range(8)] + [s[0]]
        order = S.deep_shallow(s, 0, 8)
        assert sorted(order) == list(range(len(s))) and [s[i] for i in order] == sorted(s)
        rank, lcp = S._extents(s, 0, 8)
        for i in range(len(s)):
            row = S._row(rank, lcp, i)
            for j in range(len(s)):
                assert row[j] == (-1 if i == j else len(__import__("os").path.commonprefix([s[i], s[j]])))


@pytest.mark.parametrize("chunk", [1 << 22, 50])
def test_every_window_has_its_anchor(monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rnd = random.Random(5)
    for data in (bytes(rnd.choice(b"abcd") for _ in range(700)), b"a" * 300, b"ab" * 200):
        at, h = S.anchors(np.frombuffer(data, np.uint8), 40, 8)
        hashes = S.gram_hashes(np.frombuffer(data, np.uint8), 8)
        assert np.array_equal(hashes[at], h)
        places = set()
        for p in range(len(data) - 39):
            low = [int(x) & ~((1 << 24) - 1) for x in hashes[p : p + 33]]
            places.add(p + low.index(min(low)))
        assert places == set(at.tolist())


@pytest.mark.parametrize("group", [4096, 4])
def test_as_by_hand(spark, docs_table, edge_rows, monkeypatch, group):
    """Short strings over few letters, with copies, shared passages, edits
    and periods; also with groups cut into parts."""
    monkeypatch.setattr(S, "GROUP", group)
    rnd = random.Random(9)
    passage = prose(rnd, 40)
    texts = [prose(rnd, 60) for _ in range(12)]
    texts += [texts[0], texts[1][:150] + "é" + texts[1][150:], "x" + texts[2], texts[3][20:], texts[4] + texts[4][:100]]
    texts += [prose(rnd, rnd.randint(1, 9)) + passage[rnd.randint(0, 60) : rnd.randint(90, 200)] + prose(rnd, 5) for _ in range(25)]
    texts += ["abc" * 60, "z" * 200, "z" * 60, "中文" * 40, "".join(rnd.choice("ab") for _ in range(600))]
    rows = [r for r in edge_rows if r[0] not in (8, 9)] + [(100 + i, t, "en") for i, t in enumerate(texts)]
    want = sorted(zip([str(r[0]) for r in rows], by_hand([r[1] for r in rows], 64)))
    got = S.removed_digests(docs_table(rows).repartition(3), length=64, gram=16).collect()
    assert sorted((str(r.doc_id), tuple(r)[1:]) for r in got) == want
    assert sum(r.n_removed > 0 for r in got) > 25


def test_whole_length_and_no_documents(spark, edge_docs, edge_rows, no_docs):
    want = sorted(zip([str(r[0]) for r in edge_rows], by_hand([r[1] for r in edge_rows], 400)))
    got = S.removed_digests(edge_docs).collect()
    assert sorted((str(r.doc_id), tuple(r)[1:]) for r in got) == want
    assert S.removed_digests(no_docs).count() == 0
