"""Encoding of whole texts by public tokenizers, one distinct part at a time.

A text is cut at spaces that no token crosses, and each distinct part is
encoded once while the task's process remembers it.  The tokenizers read the
missing parts of a slice of texts together, since a call costs more than a
short part.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

#: Parts a process remembers at most (about 250 bytes each); it forgets all when they are more.
MEMO = 1_000_000
#: Parts that one call encodes.
CALL = 1000
#: Texts beyond this many bytes are worked on in slices.
SLICE = 1 << 22


def vocabulary(name: str) -> str:
    """Place of a vocabulary file on this machine: an absolute path, or a name of the public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def json_tokenizer(name: str, plain_specials: bool):
    """A tokenizer file; with ``plain_specials``, the strings of special tokens are ordinary text."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    if plain_specials:
        t.encode_special_tokens = True
    return t


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def plain_words(name: str):
    """A tokenizer file's merges alone, for byte-level words with single spaces between them."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers
    t = Tokenizer.from_file(vocabulary(name))
    t.normalizer, t.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Split(" ", "removed")
    return t


@lru_cache(maxsize=4)
def piece_tokenizer(name: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))


class Memo:
    """``known``: what ``encode`` gives for distinct byte strings; it takes a list and returns a list of byte strings.

    Where ``split`` cuts a part into several, its codes are theirs, joined.
    """

    def __init__(self, encode, limit: int = MEMO, split=None):
        self.known: dict[bytes, bytes] = {}
        self.encode, self.limit, self.split = encode, limit, split or (lambda part: [part])

    def learn(self, parts: set[bytes]) -> None:
        """Encode those of ``parts`` that are not known; all of them are known afterwards."""
        new = parts.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = parts
        made = {p: s for p in new if len(s := self.split(p)) > 1}
        whole = list(new.difference(made).union(*made.values()).difference(self.known))
        for lo in range(0, len(whole), CALL):
            some = whole[lo: lo + CALL]
            self.known.update(zip(some, self.encode(some)))
        for p, s in made.items():
            self.known[p] = b"".join(map(self.known.__getitem__, s))


def slices(text: bytes, cut: re.Pattern, limit: int = SLICE):
    """A text in runs of about ``limit`` bytes that end before a match of ``cut``, a single byte that goes to neither."""
    lo = 0
    while len(text) - lo > limit:
        m = cut.search(text, lo + limit)
        if not m:
            break
        yield text[lo: m.start()]
        lo = m.end()
    yield text[lo:] if lo else text
