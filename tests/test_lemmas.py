import random

import pytest

from deckspark.operators import lemmas as LM
from deckspark.plans import corpus as CP
from deckspark.plans.corpus import lemmatize
from deckspark.schema import DROPPED_TOKENS

# regular verbs and nouns, inflected by rule
STEMS = "mach lern kauf spiel koch such hol frag leb lieb glaub dreh brauch bau teil wein lach zahl schick stell wohn hör sag schau pack dank pfleg träum klopf tanz reis folg fühl führ".split()
NOUNS = "Zeitung Wohnung Meinung Übung Lösung Hoffnung Rechnung Prüfung Sitzung Führung Richtung Heizung Leistung Ordnung Regierung Werbung".split()


def dictionary():
    out = []
    for s in STEMS:
        out += [(s + e, s + "en") for e in ("e", "st", "t", "en", "te", "test", "ten", "tet")] + [(f"ge{s}t", s + "en"), (f"ge{s}tes", s + "en")]
    for n in NOUNS:
        out += [(n, n), (n + "en", n)]
    return out


def test_edit_trees():
    assert LM.edit_tree("haus", "haus") is None
    assert LM.apply_tree(LM.edit_tree("gemacht", "machen"), "gelernt") == "lernen"
    assert LM.apply_tree(LM.edit_tree("getrunken", "trinken"), "gesunken") is None  # "tru" is not in it
    assert LM.edit_tree("x", "y") == ["x", "y"] and LM.apply_tree(["x", "y"], "z") is None
    assert LM.apply_tree(LM.edit_tree("Katzen", "Katze"), "n") is None
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 9))) for _ in range(2))
        assert LM.apply_tree(LM.edit_tree(a, b), a) == b
        n, i, j = LM.common_part(a, b)
        assert a[i : i + n] == b[j : j + n]
        assert not any(a[k : k + n + 1] in b for k in range(len(a) - n))


def test_held_out_forms(spark):
    """Nine tenths teach; the others are forms that no dictionary holds."""
    pairs = dictionary()
    rnd = random.Random(5)
    rnd.shuffle(pairs)
    cut = len(pairs) // 10
    held, taught = pairs[:cut], pairs[cut:]
    model = LM.learn(spark.createDataFrame(taught, "form string, lemma string").repartition(3))
    got = {r.form: r.lemma for r in LM.guess(spark.createDataFrame([(f,) for f, _ in held], "form string"), model).collect()}
    right = sum(got[f] == x for f, x in held) / len(held)
    assert right >= 0.9, right
    # taught forms come back as taught, where an ending decides them
    again = {r.form: r.lemma for r in LM.guess(spark.createDataFrame([(f,) for f, _ in taught], "form string"), model).collect()}
    assert sum(again[f] == x for f, x in taught) / len(taught) >= 0.95


def keys(form):
    for k in range(min(LM.HEAD, len(form)) + 1):
        for n in range(min(len(form) - k, LM.ENDING) + 1):
            yield form[:k], form[len(form) - n :]


def by_hand(taught, form):
    known = {}
    for f, x in set(taught):
        t = LM.json.dumps(LM.edit_tree(f, x), ensure_ascii=False)
        for key in keys(f):
            trees = known.setdefault(key, {})
            trees[t] = trees.get(t, 0) + 1
    tried = []
    for head, ending in keys(form):
        trees = known.get((head, ending))
        if trees:
            t = min(trees, key=lambda t: (-trees[t], t))
            tried.append((-trees[t] / (sum(trees.values()) + 1), -len(ending), -len(head), t))
    for *_, t in sorted(tried):
        found = LM.apply_tree(LM.json.loads(t), form)
        if found:
            return found
    return form


def test_guess_by_hand(spark):
    taught = dictionary()[::3] + [("gingen", "gehen"), ("", "x"), ("y" * 70, "y")]
    forms = ["gedankt", "Meinungen", "zzz", "", "q", "x" * 200, "sangen", "tanztest"]
    model = LM.learn(spark.createDataFrame([*taught, (None, "a"), ("a", None)], "form string, lemma string"))
    got = {r.w: r.lemma for r in LM.guess(spark.createDataFrame([(f,) for f in forms], "w string"), model, "w").collect()}
    short = [(f, x) for f, x in taught if 1 <= len(f) <= LM.LONGEST]
    assert got == {f: f if len(f) > LM.LONGEST or not f else by_hand(short, f) for f in forms}
    empty = LM.learn(spark.createDataFrame([], "form string, lemma string"))
    assert [r.lemma for r in LM.guess(spark.createDataFrame([("abc",)], "form string"), empty).collect()] == ["abc"]


@pytest.mark.parametrize("unseen", [False, True])
def test_lemmatize(spark, unseen):
    rows = [
        ("s1", 1, "Wir", "", "PRON", 2), ("s1", 2, "machten", "", "VERB", 2), ("s1", 3, "das", "", "X", 2), ("s1", 4, "ab", "svp", "X", 2), ("s1", 5, "auf", "svp", "X", 2),
        ("s2", 1, "gekocht", "", "VERB", 1), ("s2", 2, "zu", "svp", "X", 3), ("s2", 3, "Haus", "", "NOUN", 1), (None, 1, "sagte", "", "VERB", 1),
    ]
    tokens = spark.createDataFrame(rows, "sent string, i int, token string, dep string, pos string, head int").repartition(3)
    d = spark.createDataFrame([p for p in dictionary() if p[0] not in ("gekocht", "sagte")], "form string, lemma string")
    got = {r.sent: r.lemmas for r in lemmatize(tokens, d, unseen=LM.learn(d) if unseen else None).collect()}
    assert got["s1"] == "Wir;aufmachen;das;ab;auf"  # the last prefix wins
    assert got["s2"] == ("kochen;zu;Haus" if unseen else "gekocht;zu;Haus")
    assert got[None] == ("sagen" if unseen else "sagte")


def test_the_token_table_is_read_once(spark, tmp_path):
    rows = [("s", 1, "a", "", "X", 1)]
    spark.createDataFrame(rows, "sent string, i int, token string, dep string, pos string, head int").write.parquet(f"{tmp_path}/t")
    out = lemmatize(spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame([("a", "b")], "form string, lemma string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


@pytest.mark.parametrize("common,rows", [(400_000, 0), (3, 1_000_000), (0, 1_000_000)])
def test_tokens_stay_with_their_sentence(spark, monkeypatch, common, rows):
    """Forms known to all tasks, others by a shuffle, a trie met by a shuffle."""
    monkeypatch.setattr(CP, "COMMON", common)
    rnd = random.Random(11)
    pairs = dictionary()
    forms = [f for f, _ in pairs] + ["zzz", "ab"]
    toks = [(f"s{n}" if n else None, i, rnd.choice(forms[: 1 + rnd.randrange(len(forms))])) for n in range(60) for i in range(1, 9)] + [("s1", 9, None)]
    tokens = [(s, i, f, "svp" if f == "ab" else "", "VERB" if f and f[0].islower() else "X", 2) for s, i, f in toks]
    taught = pairs[::3]
    d = spark.createDataFrame(taught, "form string, lemma string")
    df = spark.createDataFrame(tokens, "sent string, i int, token string, dep string, pos string, head int")
    model = LM.learn(d)
    of = {f: by_hand(taught, f) for f in forms} | {f: min(x for g, x in taught if g == f) for f, _ in taught}
    monkeypatch.setattr(LM, "BROADCAST_ROWS", rows)
    scattered = [tuple(r) for r in lemmatize(df.repartition(5), d, unseen=model).collect()]
    together = lemmatize(df.repartition(3, "sent").sortWithinPartitions("sent"), d, unseen=model)
    want = {}
    for s, i, f, dep, pos, _ in tokens:
        prefix = "ab" if pos == "VERB" and i == 2 and any(x[0] == s and x[3] == "svp" for x in tokens) else ""
        want.setdefault(s, []).extend([prefix + of[f]] if f else [])
    want = {s: ";".join(x for x in found if x not in DROPPED_TOKENS) for s, found in want.items()}
    assert dict(scattered) == want == {r.sent: r.lemmas for r in together.collect()} and len(scattered) == len(want)
    assert not any("/tokens-" in f for f in together.inputFiles())  # tokens are not written
    assert "MapInArrow" in together._jdf.queryExecution().optimizedPlan().toString()
