"""Operator 3: BPE encoding and decoding by a tokenisation automaton.

**Compilation.**  The automaton reads token ids and accepts exactly the id
sequences that the merges produce.  It starts as one state with a loop for
every byte.  Each merge ``(u, v) -> w``, in order of rank, is one gadget: the
state ``q`` that ``u`` leads to is copied without its ``v`` arc, all ``u``
arcs are led to the copy, and every state with a ``u`` arc gains a ``w`` arc
to where ``v`` led from ``q``.  All arcs of a label lead to one state, so the
automaton stays deterministic.  A copy shares its origin's arcs: a state is
kept as the cuts ``(token, rank)`` that its lineage made, and an arc's
presence follows from the cuts and the ranks of the labels' merges
(:meth:`Automaton.step`); computed transitions are kept in a table.

**Encoding.**  A pre-split word is read from left to right; from each reached
position, labels found in the byte trie of the vocabulary are tried as arcs.
Every prefix has exactly one accepted path, so each position is reached once.
**Decoding** emits the arc labels' bytes.

Defined results: null text is an empty text (no ids, empty decoded text);
special strings become their special id, as the library does; repeated rows
are encoded alike; a text's length bounds a task's memory; other columns
pass through untouched except ``doc_id``/``text``.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import held
from .words import Disputed, Memo, byte_alphabet, disputed_characters, split_words

NEVER = 1 << 60
TABLE = 2_000_000


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list):
        alphabet = byte_alphabet()
        self.labels: dict[int, bytes] = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        size = max(self.labels) + 1
        self.born = [-1] * size  # rank of the merge that made a label
        self.left: list[int | None] = [None] * size
        self.rank: dict[int, int] = {}  # (u, v) -> rank
        # the cuts of the state each label leads to: the start state has none
        self.cuts: list[tuple] = [((i, -1),) for i in range(size)]
        self.shift = size
        self.dead: set[int] = set()  # labels without an arc
        for r, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            self._gadget(r, u, v, w)
        self._trie()
        self.table: dict[int, bool] = {}

    def _gadget(self, r: int, u: int, v: int, w: int) -> None:
        if self.born[w] >= 0:
            raise ValueError(f"two merges make label {w}")
        if u in self.dead or v in self.dead or not self.step(u, v):  # never side by side
            self.dead.add(w)
            return
        # w leads where v led, before u's arcs are led to the new copy; w's
        # own later cuts come on top of what it takes over
        self.cuts[w] = ((w, r), *self.cuts[v])
        # the copy of u's state without v: u's own cuts now reach to rank r
        own, *rest = self.cuts[u]
        self.cuts[u] = ((u, r), *rest)
        self.rank[u * self.shift + v] = r
        self.left[w], self.born[w] = u, r

    def _trie(self) -> None:
        """Byte trie of all labels: node -> {byte: node}, node -> label."""
        self.next: list[dict[int, int]] = [{}]
        self.at: list[int] = [-1]
        for i, label in self.labels.items():
            if i in self.dead:
                continue
            node = 0
            for b in label:
                if b not in self.next[node]:
                    self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.at.append(-1)
                node = self.next[node][b]
            self.at[node] = i

    def step(self, last: int, label: int) -> bool:
        """Has the state that ``last`` leads to an arc ``label``?  The arc
        fails if the label, or a left part of it before it was merged on, is
        among the arcs that the state's lineage cut."""
        until, part = NEVER, label
        while part is not None:
            for token, upto in self.cuts[last]:
                r = self.rank.get(token * self.shift + part)
                if r is not None and r <= upto and r <= until:
                    return False
            part, until = self.left[part], self.born[part]
        return True

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        if n == 1:
            return [self.at[self.next[0][word[0]]]]
        reached: list = [None] * (n + 1)  # position -> (label, start)
        nxt, at, table, size = self.next, self.at, self.table, self.shift
        for i in range(n):
            if i and reached[i] is None:
                raise ValueError(f"no path through {word!r} at {i}")
            last = reached[i][0] if i else -1
            node, j = 0, i
            while j < n:
                node = nxt[node].get(word[j])
                if node is None:
                    break
                j += 1
                label = at[node]
                if label < 0 or reached[j] is not None:
                    continue
                if i:
                    key = last * size + label
                    ok = table.get(key)
                    if ok is None:
                        if len(table) >= TABLE:
                            table.clear()
                        ok = table[key] = self.step(last, label)
                    if not ok:
                        continue
                reached[j] = (label, i)
            if reached[n] is not None:  # only one path reaches the end
                break
        out, j = [], n
        while j:
            label, j = reached[j]
            out.append(label)
        return out[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


def compile_file(path: str) -> tuple[Automaton, dict[str, int]]:
    """The automaton of a tokenizer file and its special strings' ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    machine = Automaton({t: i for t, i in spec["model"]["vocab"].items() if t not in special}, merges)
    for text, i in special.items():
        machine.labels[i] = text.encode()
    return machine, special


class Codec:
    """Texts to ids and back; pieces met before come from a bounded memo."""

    def __init__(self, path: str, disputed: str):
        from tokenizers import Tokenizer

        self.machine, self.special = compile_file(path)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.disputed, self.pre = Disputed(disputed), Tokenizer.from_file(path).pre_tokenizer
        piece = lambda p: self._words(split_words(p))
        self.memo = Memo(piece, lambda new: list(map(piece, new)))

    def _words(self, words) -> bytes:
        encode = self.machine.encode_word
        return np.array([i for w in words for i in encode(w.encode())], "<u4").tobytes()

    def _plain(self, texts: list[str]) -> list[bytes]:
        free = [self.disputed.free(t) for t in texts]
        out = self.memo.encode([t if f else "" for t, f in zip(texts, free)])
        for i, f in enumerate(free):
            if not f:  # words as the library's splitter has them
                out[i] = self._words(texts[i][a:b] for _, (a, b) in self.pre.pre_tokenize_str(texts[i]))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not any(s in t for s in self.special for t in texts):
            return self._plain(texts)
        out = []
        for t in texts:
            parts = [p for p in self.cut.split(t) if p]
            plain = iter(self._plain([p for p in parts if p not in self.special]))
            out.append(b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else next(plain) for p in parts))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8; broken sequences become U+FFFD."""
        return self.machine.decode(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace").encode()


def _encoder(tokenizer_path: str):
    from tokenizers import Tokenizer

    disputed = disputed_characters(Tokenizer.from_file(tokenizer_path))

    def codec() -> Codec:
        return held(("codec", tokenizer_path), lambda: Codec(tokenizer_path, disputed))

    return codec


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids array<int>): one row per row of ``docs``."""
    codec = _encoder(tokenizer_path)

    def run(batches):
        c = codec()
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for at in range(0, len(texts), 256):
                ids = [np.frombuffer(x, "<u4").astype("int32") for x in c.encode(texts[at : at + 256])]
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[at : at + 256], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _read(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    codec = _encoder(tokenizer_path)

    def run(batches):
        c = codec()
        for b in batches:
            texts = [None if x is None else c.decode(np.array(x, "<u4").tobytes()).decode() for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_digests(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the text that
    they decode to, and the ids themselves if asked for.  One scan, no
    shuffle."""
    codec = _encoder(tokenizer_path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        c = codec()
        for b in batches:
            doc_ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                ids = c.encode([t or "" for t in texts[at : at + 256]])
                cols = [
                    doc_ids.slice(at, 256),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids], pa.string()),
                ]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _read(docs).mapInArrow(run, schema)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
