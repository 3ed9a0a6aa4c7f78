"""Splitting text for byte-level BPE, and a bounded memo of split pieces.

The public split pattern never joins text across a single space that a
non-space follows, so a text is cut there first and each piece (with its
space before it) is looked up in a memo; only pieces not met before are split
by the pattern and encoded.  The memo forgets when full, which bounds a
worker's memory and never changes a result.
"""

from __future__ import annotations

import re

import regex

# fixed values: the public tokenizer's split pattern and special string
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")
MEMO = 800_000  # entries of some 200 bytes
ASKED = 1 << 14  # characters the library is asked about at once


def split_words(text: str) -> list[str]:
    """The pre-split words of a text without special strings."""
    return _split(text)


_split = regex.compile(SPLIT).findall


def has_wide_space(text: str) -> bool:
    """Whether some space has no non-space behind it."""
    return bool(_ODD.search(text))


def pieces(text: str) -> list[str]:
    """``text`` cut before every single space that a non-space follows,
    without that space: " ".join of the pieces is the text."""
    return _CUT.split(text) if has_wide_space(text) else text.split(" ")


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself,
    the other bytes for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def disputed_characters(tokenizer) -> str:
    """Characters that the pattern and the library's splitter class
    differently (their Unicode versions differ); texts holding one are split
    by the library itself.  Found by asking the library, once per run: the
    characters of one class, behind a sure member of it, must come back as
    one word; a run that does not is halved."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out: list[str] = []

    def agree(sure: str, run: str) -> None:
        if len(tokenizer.pre_tokenizer.pre_tokenize_str(sure + run)) == 1:
            return
        if len(run) == 1:
            out.append(run)
            return
        agree(sure, run[: len(run) // 2])
        agree(sure, run[len(run) // 2 :])

    for sure, kind in (("a", r"\p{L}"), ("1", r"\p{N}"), ("\n", r"\s"), ("!", r"[^\s\p{L}\p{N}]")):
        run = "".join(regex.findall(f"{kind}+", every))
        for at in range(0, len(run), ASKED):
            agree(sure, run[at : at + ASKED])
    return "".join(out)


class Disputed:
    """Tests texts for disputed characters."""

    def __init__(self, characters: str):
        self.odd = set(characters)
        self.high = re.compile(f"[{re.escape(min(characters))}-\U0010ffff]").search if characters else None

    def free(self, text: str) -> bool:
        return not self.odd or text.isascii() or not self.high(text) or self.odd.isdisjoint(text)


class Memo:
    """Encodes texts piece by piece.  ``encode_first`` gives the bytes of a
    text's first piece, ``encode_many`` those of a list of later pieces, each
    with the space before it.  Pieces are known in two generations of at most
    ``limit / 2``: when the younger is full it becomes the older, and what the
    older held and was not met again is forgotten."""

    def __init__(self, encode_first, encode_many, limit: int = MEMO):
        self.encode_first, self.encode_many, self.limit = encode_first, encode_many, limit
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [pieces(t) for t in texts]
        found = [[None, *map(self.known.get, c[1:])] for c in cut]
        for c, f in zip(cut, found):
            f[0] = self.encode_first(c[0])
        holes = [[i for i, x in enumerate(f) if x is None] for f in found]
        unknown = {c[i] for c, h in zip(cut, holes) for i in h}
        got = {p: x for p in unknown if (x := self.old.get(p)) is not None}
        new = [p for p in unknown if p not in got]
        if new:
            got.update(zip(new, self.encode_many([" " + p for p in new])))
        if len(self.known) + len(got) > self.limit // 2:
            self.old, self.known = self.known, {}
        self.known.update(got)
        for c, f, h in zip(cut, found, holes):
            for i in h:
                f[i] = got[c[i]]
        return list(map(b"".join, found))
