"""Exact encoding and decoding with a word-level BPE tokenizer file, word by word.

The tokenizer drops white space and never builds a token across it, so the ids of a text are the
ids of its white-space separated words in order.  A worker remembers the words and word pieces it
has met (bounded).  A new word of plain characters is lowered and split by the file's pattern, and
its pieces go to the library's BPE model; any other word goes through the whole tokenizer, and
texts with the control characters that Python counts as white space and the tokenizer doesn't go
to it whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

KNOWN_WORDS, KNOWN_PIECES = 400_000, 250_000
ODD_SPACE = re.compile("[\x1c-\x1f]")
# printable ASCII and Latin-1 letters: lower case and NFC keep them one character each
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# fixed value: the tokenizer file's split pattern, for plain lower-case characters
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")


def byte_letters() -> dict[int, str]:
    """Plain characters beyond ASCII as byte-level text: a UTF-8 byte that prints stands for itself,
    the others in order are the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordBpe:
    """``encode`` and ``decode`` as the library's, over packed ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.names: dict[int, str] = {v: k for k, v in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.letters = byte_letters()
        self.ids: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode_whole(self, text: str) -> bytes:
        return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, text: str) -> bytes:
        got = self.pieces.get(text)
        if got is None:
            if len(self.pieces) >= KNOWN_PIECES:
                self.pieces.clear()
            shown = text if text.isascii() else text.translate(self.letters)
            got = self.pieces[text] = pack([t.id for t in self.model.tokenize(shown)])
        return got

    def word(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text) or "<|" in text:  # other characters, and special tokens
            return self.encode_whole(text)
        low = text.lower()
        return self.piece(low) if low.isalpha() else b"".join(map(self.piece, PIECES.findall(low)))

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if ODD_SPACE.search(text):
            return self.encode_whole(text)
        words = text.split()
        try:
            return b"".join(map(self.ids.__getitem__, words))
        except KeyError:
            known = self.ids
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.word(w)
            return b"".join(map(known.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        """Text of packed ids as the library's decode (no decoder: token strings joined by spaces)."""
        return " ".join(map(self.names.__getitem__, unpack(ids)))


@lru_cache(maxsize=2)
def _loaded(path: str, size: int, changed: int) -> WordBpe:
    return WordBpe(path)


def word_bpe(path: str) -> WordBpe:
    """The tokenizer of a file, kept with the words it knows for all tasks of a worker process."""
    at = os.stat(path)
    return _loaded(path, at.st_size, at.st_mtime_ns)


def pack(ids) -> bytes:
    return array("I", ids).tobytes()


def unpack(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    return out
