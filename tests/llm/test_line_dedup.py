import random

import pytest
import xxhash

from deckspark.llm import line_dedup as L

from .conftest import prose


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def slow_fingerprint(line):
    bare = {"".join(c for c in w if c.isalnum()) for w in line.split(" ")} - {""}
    h = [xxhash.xxh64_intdigest(w) for w in bare]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def by_hand(rows):
    """Groups of lines by comparing all pairs; the first occurrence stays."""
    places = []
    for doc_id, th, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if text is not None and any(c.isalnum() for c in line):
                places.append(((doc_id is not None, doc_id or 0, th, pos), L.normalise(line)))
    different = sorted({line for _, line in places})
    fp = {line: slow_fingerprint(line) for line in different}
    group = {line: line for line in different}
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if (fp[a] ^ fp[b]).bit_count() <= L.RADIUS and levenshtein(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                x, y = group[a], group[b]
                if x != y:
                    group = {k: x if v == y else v for k, v in group.items()}
    first = {}
    for place, line in sorted(places):
        first.setdefault(group[line], place)
    gone = {place for place, line in places if first[group[line]] != place}
    out = []
    for doc_id, th, text in rows:
        if text is not None:
            text = "\n".join(x for pos, x in enumerate(text.split("\n")) if (doc_id is not None, doc_id or 0, th, pos) not in gone)
        out.append((str(doc_id), text))
    return sorted(out, key=str)


def test_edit_distance():
    rnd = random.Random(4)
    for _ in range(1500):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14)))
        d = levenshtein(a, b)
        for most in (0, 2, 5, 20):
            assert L.edit_distance(a, b, most) == (d if d <= most else most + 1)
            assert L._by_diagonals(a, b, most) == (d if d <= most else None)
    for n in (600, 3000):
        a = "".join(rnd.choice("abcdefgh ") for _ in range(n))
        for edits in (1, 9, 150):
            b = list(a)
            for _ in range(edits):
                i = rnd.randrange(len(b))
                b[i : i + rnd.randrange(3)] = rnd.choice(["", "x", "yz"])
            b = "".join(b)
            assert L.edit_distance(a, b, n) == L._by_bits(a, b, n) == L._by_diagonals(a, b, n)


@pytest.mark.parametrize("limit", [512, 3])
def test_as_by_hand(spark, docs_table, edge_rows, monkeypatch, limit):
    """Also with a limit that cuts nodes into parts."""
    monkeypatch.setattr(L, "TEXT_LIMIT", limit)
    rnd = random.Random(8)
    shared = [prose(rnd, 60) for _ in range(6)]
    fuzzy = lambda s: s.replace("river", "rivers", 1) if rnd.random() < 0.5 else s.upper() + "  "
    rows = [r for r in edge_rows if r[0] != 8]
    rows += [(100 + i, "\n".join([prose(rnd, 12), fuzzy(rnd.choice(shared)), "", "---", f"page {i}", prose(rnd, 9)]), "en") for i in range(25)]
    docs = docs_table(rows)
    keyed = [(r.doc_id, r.th, r.text) for r in L._keyed(docs).collect()]
    got = L.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines_removed"]
    rows = got.collect()
    assert sorted(((str(r.doc_id), r.text) for r in rows), key=str) == by_hand(keyed)
    assert sum(r.n_lines_removed for r in rows) > 30


def test_no_documents(no_docs):
    assert L.dedup_lines(no_docs).count() == 0


def test_folding_as_by_character():
    for text in ("", "Page 1907, No 5²", "Σ 42 ÉTÉ", "١٢ and 12 ３", "İ 7 ๓"):
        assert L._folded(text) == L._DIGIT.sub("0", text.lower())


def test_fingerprints_of_long_lines():
    """Runs of more than 255 words are counted in parts."""
    rnd = random.Random(3)
    lines = ["a", "--- _ !", "one two two", "don't don't stop_here"]
    for n in (254, 255, 256, 511, 1300):
        words = [f"w{rnd.randrange(10**9)}" for _ in range(n)]
        lines += [" ".join(words), " ".join(words + words[: n // 2])]
    assert [x % 2**64 for x in L.line_fingerprints(lines).tolist()] == [slow_fingerprint(x) for x in lines]
    assert L.line_fingerprints([]).tolist() == []


def test_near_copies_need_no_exact_distance(monkeypatch):
    rnd = random.Random(12)
    for _ in range(300):
        a = " ".join(rnd.choice(["x", "yy", "zig", "zag", "w" * 9, ""]) for _ in range(rnd.randint(0, 14)))
        b = a.split(" ")
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(b) + 1)
            b[i : i + rnd.randrange(3)] = rnd.choice([[], ["new"], ["zag", "x"]])
        b = " ".join(b)
        assert L._bound(a, b) >= levenshtein(a, b)
        assert L.similar(a, b) == (levenshtein(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))

    def never(*_):
        raise AssertionError("the exact distance of an evident copy")

    monkeypatch.setattr(L, "edit_distance", never)
    words = [f"{prose(rnd, 1)}{rnd.randrange(400)}" for _ in range(900)]
    other = list(words)
    for i in range(0, 900, 20):
        other[i : i + 1] = rnd.choice([[], ["changed"], [words[i], "added"]])
    assert L.similar(" ".join(words), " ".join(other))
