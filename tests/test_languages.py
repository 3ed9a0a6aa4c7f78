"""Queries by language over documents of other languages and of none."""

import duckdb
import pytest

import __spark_entry__ as E

from test_oracles import norm

ROWS = [
    (1, "der fluss\ngeht weiter", "de", "web", 21),
    (2, "the river runs", "en", "web", 14),
    (3, "il fiume corre", "it", "web", 14),
    (4, "il mare", "it", "books", 7),
    (5, "rzeka i morze", "pl", "books", 13),
    (6, "nobody knows", None, "web", 12),
    (7, "the sea", "en", None, 7),
    (8, None, "fr", "web", 0),
]


@pytest.mark.parametrize("name", ["se08_merge_decks", "jn15_language_pairs", "jn17_deck_titles"])
def test_any_language(spark, tmp_path, name):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = E.queries()[name](spark, f"file://{tmp_path}")
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.execute(E.oracle_sql()[name])
    at = [[d[0] for d in rel.description].index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got
