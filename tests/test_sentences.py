import random

import pytest

from deckspark.operators.sentences import learn_sentence_ends, split_sentences

NAMES = "Smith Jones Miller Brown Taylor Wilson Davies Evans".split()
WORDS = "the a house river walked to near old new garden with and quiet road then we they saw".split()


def prose(n=400, seed=1):
    """Sentences whose words also stand in the middle of others; titles and
    times with their full stops."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        body = [rnd.choice(WORDS) for _ in range(rnd.randint(4, 9))]
        if rnd.random() < 0.4:
            body.insert(rnd.randrange(1, len(body)), f"{rnd.choice(['Dr.', 'Mr.', 'St.'])} {rnd.choice(NAMES)}")
        if rnd.random() < 0.2:
            body.insert(rnd.randrange(1, len(body)), f"at {rnd.randint(1, 12)} p.m.")
        first, *rest = " ".join(body).split(" ")
        out.append(" ".join([first[0].upper() + first[1:], *rest]) + rnd.choice([".", ".", ".", "!", "?"]))
    return out


@pytest.fixture(scope="module")
def model(spark):
    sentences = prose()
    texts = [" ".join(sentences[i : i + 8]) for i in range(0, len(sentences), 8)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    return learn_sentence_ends(df).cache()


def split(spark, model, *texts):
    df = spark.createDataFrame([(i, t, "x", 9) for i, t in enumerate(texts)], "id long, text string, sentence string, line int")
    out = split_sentences(df, model)
    assert out.columns == ["id", "text", "line", "i", "sentence"]
    got = {}
    for r in out.orderBy("id", "i").collect():
        got.setdefault(r.id, []).append(r.sentence)
        assert r.i == len(got[r.id])
    return [got.get(i, []) for i in range(len(texts))]


def test_what_is_learnt(model):
    short = {r.kind for r in model.where("abbreviation").collect()}
    assert {"dr", "mr", "st", "p.m"} <= short and not short & set(WORDS)
    assert "the" in {r.kind for r in model.where("starter").collect()}


def test_abbreviations_do_not_end_sentences(spark, model):
    one = "Dr. Smith met Mr. Jones at 3 p.m. in St. Ives."
    got = split(spark, model, one, one + " The river!  (We saw it.) Then?", "They came at 3 p.m. The road was quiet.", "Wait... then the road. A house... The end.")
    assert got[0] == [one]
    assert got[1] == [one, "The river!", "(We saw it.)", "Then?"]
    assert got[2] == ["They came at 3 p.m.", "The road was quiet."]
    assert got[3] == ["Wait... then the road.", "A house...", "The end."]


def test_edge_cases(spark, model):
    got = split(spark, model, None, "", " \t\n ", "one", "a.\nb. c\n\n d", "a.\nb. c\n\n d", "Mr.", "...", '"He left." The end', "x\t  y. z\r")
    assert got == [[], [], [], ["one"], ["a.", "b.", "c", "d"], ["a.", "b.", "c", "d"], ["Mr."], ["..."], ['"He left."', "The end"], ["x y.", "z"]]
    none = spark.createDataFrame([], "text string")
    assert learn_sentence_ends(none).count() == 0 and split_sentences(none, learn_sentence_ends(none)).count() == 0


def test_accuracy_on_other_prose(spark, model):
    """Boundaries of prose that the model has not seen."""
    held = prose(300, seed=2)
    texts = [held[i : i + 6] for i in range(0, len(held), 6)]
    got = split(spark, model, *[" ".join(t) for t in texts])
    right = sum(len(set(g) & set(t)) for g, t in zip(got, texts))
    assert right / len(held) > 0.97
