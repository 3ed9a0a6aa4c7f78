import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, root int, h double, score string"


@pytest.fixture(scope="session")
def docs_table(spark):
    """Small documents with every edge case and clashing extra columns."""

    def make(rows):
        full = [(i, t, lang, "s", None if t is None else len(t), "x", 1, 0.5, "y") for i, t, lang in rows]
        return spark.createDataFrame(full, DOCS)

    return make


WORDS = "alpha bravo carbon delta ember frost glade harbor island jungle kernel lumen meadow nectar ocean prairie quartz river summit tundra".split()


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ed", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    rnd = random.Random(11)
    base = prose(rnd, 120)
    long = "\n".join(prose(rnd, 40) for _ in range(400))
    return [
        (1, base, "en"),
        (2, base, "en"),  # an exact copy
        (2, base, "en"),  # a repeated row
        (3, base.replace("ocean", "lake"), "en"),
        (4, "", "en"),
        (5, None, None),
        (None, prose(rnd, 90), "en"),
        (None, None, "en"),
        (6, "   \n\t ", None),
        (7, "12345 !!! 中文 \U0001f600 café <|endoftext|> end", "en"),
        (8, long, "en"),
        (9, "word " * 3000, "en"),
        (10, "El perro corre por la casa y el gato duerme en la silla", "es"),
        (11, "a", "en"),
    ]


@pytest.fixture(scope="session")
def edge_docs(docs_table, edge_rows):
    return docs_table(edge_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs_table):
    return docs_table([])
