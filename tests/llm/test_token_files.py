import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from deckspark.llm import token_files as T
from deckspark.llm.queries import tokenizer_path
from deckspark.llm.token_files import open_sequences, read_documents, sequence, write_token_files
from deckspark.llm.words import disputed_characters


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def expected(library, rows):
    """doc_id -> (start, n, crc) by the library alone, rows in id order."""
    start, out = 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_edge_cases_as_the_library(spark, library, edge_docs, edge_rows):
    manifest = write_token_files(edge_docs, tokenizer_path(), 2, seq_len=32, rows_per_batch=4, shards=3)
    got = [tuple(r)[:4] for r in read_documents(spark, manifest).collect()]
    want = expected(library, edge_rows)
    by_id = lambda x: (x[0] is not None, x[0] or 0, x[1])
    ided = [x for x in sorted(got, key=by_id) if x[0] is not None]
    assert ided == [x for x in want if x[0] is not None]
    # the order of the rows without an id is that of a hash of their text
    assert sorted(x[2:] for x in got if x[0] is None) == sorted(x[2:] for x in want if x[0] is None)


def test_random_access_without_copies(spark, library, edge_docs):
    manifest = write_token_files(edge_docs, tokenizer_path(), 2, seq_len=16, rows_per_batch=3, shards=1)
    row = manifest.first()
    batches = open_sequences(row["path"])
    assert sum(b.num_rows for b in batches) == row["n_sequences"]
    assert {b.num_rows for b in batches[:-1]} == {3}
    everything = np.concatenate([b.column(0).flatten().to_numpy() for b in batches])
    for i in (0, 1, 7, row["n_sequences"] - 1):
        view = sequence(batches, i).to_numpy(zero_copy_only=True)
        assert view.base is not None and np.array_equal(view, everything[i * 16 : i * 16 + 16])
    masks = np.concatenate([sequence(batches, i, "attention_mask").to_numpy(zero_copy_only=False) for i in range(row["n_sequences"])])
    assert masks.sum() == row["n_tokens"] and masks[: row["n_tokens"]].all()
    ends = np.concatenate([sequence(batches, i, "document_end").to_numpy(zero_copy_only=False) for i in range(row["n_sequences"])])
    assert ends.sum() == row["n_docs"]


def test_no_documents(spark, no_docs):
    manifest = write_token_files(no_docs, tokenizer_path(), 2)
    assert manifest.count() == 0 and read_documents(spark, manifest).count() == 0


@pytest.mark.parametrize("limit", [5, 1000])
def test_distinct_pieces_are_asked_for_once(library, monkeypatch, limit):
    """Words that repeat within the texts encoded together cost one look-up;
    ids stay those of the library, also when the memo forgets."""
    disputed, asked = disputed_characters(library), []
    numbers = T._PieceIds.numbers

    def recorded(self, distinct):
        self.limit = limit
        asked.append(distinct)
        return numbers(self, distinct)

    monkeypatch.setattr(T._PieceIds, "numbers", recorded)
    encode = T.library_encoder.__wrapped__(tokenizer_path(), np.uint16, disputed)
    texts = ["first one two one two", "one two one", "two first"]
    assert [x.tolist() for x in encode(texts)] == [library.encode(t).ids for t in texts]
    assert [sorted(x) for x in asked] == [["first", "one", "two"]]
    odd = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n a\t b", "don't  stop 'll", "a<|endoftext|> b", "é ü　 中文 ß", "a" + disputed[:2] + " b", "x\x1c y \x85z", "\x00 \x00"]
    rnd = random.Random(7)
    for _ in range(6):
        texts = odd + ["".join(rnd.choice(" \n\tab.'1é中") for _ in range(rnd.randint(0, 60))) for _ in range(80)]
        rnd.shuffle(texts)
        got = encode(texts)
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert all(x.dtype == np.uint16 for x in got)


def test_texts_beyond_one_slice(spark, library, docs_table, monkeypatch):
    """Documents of a batch that are encoded in several parts."""
    monkeypatch.setattr(T, "SLICE", 40)
    rows = [(i, None if i == 5 else f"text {i} " + "word " * (i % 9), "en") for i in range(40)]
    for slices in (T.SLICE, 1 << 20):
        monkeypatch.setattr(T, "SLICE", slices)
        got = read_documents(spark, write_token_files(docs_table(rows), tokenizer_path(), 2, shards=2)).collect()
        assert sorted(tuple(r)[:4] for r in got) == expected(library, rows)
