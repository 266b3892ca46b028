"""Token ids of whole texts through a memory of words.

The tokenizer never joins tokens across ASCII white space, so a text's ids are its words' ids in a row.
New words are encoded together, separated by single spaces, and told apart by their offsets.

A tokenizer that lower-cases and then cuts text by ``PIECES`` needs no words where a text is Latin-1, as most are:
such text is NFC already, its lower case is Python's, and each of its pieces goes to the tokenizer's model once.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import numpy as np

#: Words and pieces kept in a worker's memory; beyond that it starts anew.
REMEMBERED = 300_000
_SPACE = re.compile(r"[\t\n\r\x0b\x0c]")
_MADE: dict[str, WordTokenizer] = {}

#: What a tokenizer file must say for texts to be cut here.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(256)) if unicodedata.category(c)[0] == kind)


_L, _N, _S = _class("L"), _class("N"), "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0"
#: ``PIECES`` for Latin-1. Only the alternatives that begin with an apostrophe can start at the same character as the last.
_PIECE = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^{_S}{_L}{_N}]+")


def _byte_level() -> dict[int, str]:
    """The characters that a byte-level model has for those of Latin-1, where they are others."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    every = {c: "".join(names[b] for b in chr(c).encode()) for c in range(256)}
    return {c: name for c, name in every.items() if name != chr(c)}


_BYTE_LEVEL = _byte_level()


class Pieces(dict):
    """The ids of pieces; the model gives those of a new one."""

    def __init__(self, model):
        self.tokenize = model.tokenize

    def __missing__(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        ids = [t.id for t in self.tokenize(piece if plain else piece.translate(_BYTE_LEVEL))]
        found = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.pieces = Pieces(self.tokenizer.model)
        # Tokens that are cut from a text before all else; a text that holds one is taken by words.
        said = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in said["added_tokens"]]
        self.cuts = (
            (said["normalizer"], said["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER)
            and said["truncation"] is said["padding"] is None
            and not any(t["normalized"] for t in said["added_tokens"])
        )

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """The worker's own instance for this file."""
        return _MADE.get(path) or _MADE.setdefault(path, cls(path))

    def learn(self, words: list[str], at_once: int = 4000) -> None:
        for first in range(0, len(words), at_once):
            some = words[first : first + at_once]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            begins = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            # The first token of each word, found by the place where the word before it ends.
            cuts = np.searchsorted(begins, ends, "left").tolist()
            left = 0
            for word, right in zip(some, cuts, strict=True):
                self.known[word] = ids[left:right].tobytes()
                left = right

    def by_piece(self, text: str) -> bool:
        if not self.cuts or any(token in text for token in self.added):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def batch(self, texts: list[str]):
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        for text in texts:
            if len(self.known) + len(self.pieces) > REMEMBERED:
                self.known = {"": b""}
                self.pieces.clear()
            if self.by_piece(text):
                yield b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))
                continue
            words = _SPACE.sub(" ", text).split(" ")
            new = set(words).difference(self.known)
            if new:
                self.learn(list(new))
            yield b"".join(map(self.known.__getitem__, words))
