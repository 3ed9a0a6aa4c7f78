import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from deckspark.llm.bpe_automaton import Automaton, Codec, decode_documents, encode_digests, encode_documents
from deckspark.llm.queries import tokenizer_path
from deckspark.llm.words import Memo, disputed_characters, pieces


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def codec(library):
    return Codec(tokenizer_path(), disputed_characters(library))


def by_merging(word: str, merges: list) -> list[str]:
    """Plain BPE: merge the best-ranked pair, leftmost first."""
    parts, rank = list(word), {m: r for r, m in enumerate(merges)}
    while True:
        best = min((rank.get(p, 1e9) for p in zip(parts, parts[1:])), default=1e9)
        if best == 1e9:
            return parts
        pair, out, i = merges[best], [], 0
        while i < len(parts):
            if tuple(parts[i : i + 2]) == pair:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


@pytest.mark.parametrize("merges", [
    [("a", "a"), ("aa", "a"), ("aa", "aa")],
    [("a", "b"), ("b", "a"), ("ab", "a"), ("ba", "ba"), ("aba", "b")],
    [("b", "b"), ("a", "bb"), ("a", "a"), ("aa", "bb"), ("bb", "a")],
])
def test_small_merge_tables_on_all_words(merges):
    vocab = {c: i for i, c in enumerate("ab")}
    for m in merges:
        vocab.setdefault("".join(m), len(vocab))
    machine = Automaton(vocab, merges)
    for n in range(1, 11):
        for k in range(1 << n):
            word = format(k, f"0{n}b").replace("0", "a").replace("1", "b")
            assert [machine.labels[i].decode() for i in machine.encode_word(word.encode())] == by_merging(word, merges)


def test_random_words_as_the_library(codec, library):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 25))) for _ in range(2000)]
    words += ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40))) for _ in range(500)]
    words += ["".join(chr(rnd.randint(33, 0x2FFF)) for _ in range(6)) for _ in range(1000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode(words)]
    assert got == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", " a", "a ", "\n\n a", "a \n b", "it's  we'll\t\tx", "　x \xa0y", "x<|endoftext|>y  <|endoftext|>"])
def test_pieces_join_back_and_encode_alike(codec, library, text):
    assert " ".join(pieces(text)) == text
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == ids
    assert codec.decode(codec.encode([text])[0]).decode() == library.decode(ids, skip_special_tokens=False)


def test_a_full_memo_changes_nothing():
    memo = Memo(str.encode, lambda new: [p.encode() for p in new], limit=2)
    for texts in (["a b c d a", " b  c"], ["", " "], ["e f g h e a b c"], ["x y"]):
        assert memo.encode(texts) == [t.encode() for t in texts]


def test_edge_cases_as_the_library(edge_docs, edge_rows, no_docs, library):
    def digests(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    got = sorted((str(r[0]), *r[1:4]) for r in encode_digests(edge_docs, tokenizer_path()).collect())
    assert got == sorted((str(i), *digests(t)) for i, t, _ in edge_rows)
    assert encode_digests(no_docs, tokenizer_path()).count() == 0


def test_round_trip(edge_docs, edge_rows):
    back = decode_documents(encode_documents(edge_docs, tokenizer_path()), tokenizer_path())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t, _ in edge_rows)
