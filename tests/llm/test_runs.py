import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deckspark.llm.queries import rewritten
from deckspark.llm.runs import collapse, find_runs, least_common, periodic_runs

from .oracle import assert_equals_sql


def brute(w, least=24, times=3):
    """Every run, by extending the stretch of each period."""
    spans = {}
    for q in range(1, len(w) // times + 1):
        s = 0
        while s + q < len(w):
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            length = e + q - s
            if length >= max(least, times * q):
                spans.setdefault((s, length), q)  # the smallest period comes first
            s = e + 1
    return sorted(((s, n, q) for (s, n), q in spans.items()), key=lambda r: (r[0], r[2]))


words = lambda s: [x.encode() for x in s]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4), st.integers(3, 9), st.integers(3, 4))
def test_small_alphabets(texts, least, times):
    assert find_runs([words(t) for t in texts], least, times) == [brute(t, least, times) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_planted_repetitions(data):
    """Stretches of all periods, of periodic periods, next to each other and nested."""
    texts = []
    for _ in range(data.draw(st.integers(1, 3))):
        t = []
        for _ in range(data.draw(st.integers(0, 5))):
            unit = data.draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=14))
            unit = unit * data.draw(st.integers(1, 4))
            n = data.draw(st.integers(0, 6 * len(unit)))
            t += (unit * 7)[:n] + data.draw(st.lists(st.sampled_from("abcxyz"), max_size=4))
        texts.append(t)
    assert find_runs([words(t) for t in texts]) == [brute(t) for t in texts]


def test_least_common_length_of_a_pair():
    assert least_common(24, 3) == 16
    for least in range(1, 60):
        assert least_common(least, 3) == min(max(least, 3 * q) - q for q in range(1, 200))


def test_one_word_and_many_words():
    for n in (23, 24, 25, 5000):
        assert find_runs([words(["a"] * n)]) == [[(0, n, 1)] if n >= 24 else []]
    rnd = random.Random(1)
    phrase = [rnd.choice("abcdefgh") for _ in range(40)]
    far = [x for i in range(300) for x in [*phrase, f"w{i}"]]  # repeats, but never side by side
    assert find_runs([words(far), words(far[:-1]), []]) == [brute(far), brute(far[:-1]), []]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def by_hand(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    assert collapse(words(w), runs).decode() == kept
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha(lines), sha(kept))


def test_documents_with_edge_cases(spark, docs_table, edge_rows, no_docs, tmp_path):
    from deckspark.llm.queries import QUERIES

    rnd = random.Random(8)
    rows = [r for r in edge_rows if r[0] != 8]  # by_hand is quadratic
    rows += [(20, "a b " * 30 + "c", "en"), (21, "x\x1cy\u00a0z\u2028 " * 40, "en"), (22, "q\t\n\x0b\x0c\rr " * 24, None)]
    rows += [(i, " ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(200))), "en") for i in range(100, 400)]
    docs_table(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    want = [by_hand(i, t) for i, t, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) > 10
    assert periodic_runs(no_docs).count() == 0


def test_many_texts_of_a_batch_and_long_ones(spark, monkeypatch):
    import deckspark.llm.runs as R

    monkeypatch.setattr(R, "CHUNK", 500)  # words that a task handles at a time
    rnd = random.Random(4)
    texts = [" ".join(["a", "b"] * rnd.randrange(40) + [rnd.choice("abc") for _ in range(rnd.randrange(60))]) for _ in range(200)]
    longer = " ".join(str(i % 997) for i in range(60_000))
    df = spark.createDataFrame([*enumerate(texts), (1000, longer)], "doc_id long, text string").coalesce(1)
    one = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(df).collect()}
    assert one.pop(1000) == [(0, 60_000, 997)]
    assert one == {i: brute(t.split()) for i, t in enumerate(texts)}
    assert find_runs([words(t.split()) for t in texts]) == [one[i] for i in range(200)]


def test_rewriting_is_that_of_the_contract(spark, docs_table):
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(37)), "en") for i in range(200)]
    got = {r.doc_id: r.t for r in docs_table(rows).select("doc_id", rewritten().alias("t")).collect()}
    changed = [i for i, t, _ in rows if got[i] != t]
    assert changed and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_equals_sql(spark, "op12_periodic_runs", f"/root/testdata/{sf}", ["documents"])
