"""Token ids by the ``tokenizers`` library, with each distinct pre-token encoded once per worker.

A BPE model encodes every pre-token on its own, so the ids of a text are the
concatenated ids of its pre-tokens. ``Encoder`` splits a text with the
tokenizer's own pattern, restricted to Latin-1 where its classes are plain
ranges, and asks the library's model for each pre-token that the worker has
not seen lately. Texts with any other character, texts that hold an added token's
string, and tokenizers of another shape, go whole to the library. So the
operators' ids are those of ``encode(text, add_special_tokens=False)``, where
the string of a special token inside a text is that token.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np

LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\\t-\\r \x85\xa0"
#: Tried after letters and numbers, which begin otherwise.
CONTRACTIONS = "'(?:s|t|re|ve|m|ll|d)"

#: Entries a worker remembers at most; past it the memory is dropped and filled anew.
REMEMBERED = 600_000
#: Longer pre-tokens are encoded but not remembered.
LONGEST = 48


def _byte_symbols() -> dict[int, str]:
    """Byte-level BPE writes each byte as one character: visible Latin-1 ones as
    themselves, the others in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _latin1_symbols() -> dict[int, str]:
    symbols = _byte_symbols()
    return {c: "".join(symbols[b] for b in chr(c).encode()) for c in range(256)}


class _Known(dict):
    """pre-token -> little-endian ids."""

    def __init__(self, model, dtype):
        self.tokenize, self.symbols, self.kind = model.tokenize, _latin1_symbols(), {2: "H", 4: "I"}[dtype.itemsize]

    def __missing__(self, word: str) -> bytes:
        symbols = word if word.isalnum() and word.isascii() else word.translate(self.symbols)  # ASCII letters and digits stand for themselves
        ids = array(self.kind, [t.id for t in self.tokenize(symbols)])
        if sys.byteorder == "big":
            ids.byteswap()
        ids = ids.tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Of one vocabulary file. With ``special_as_text`` strings of special tokens are ordinary text; ``encoder``, which the operators use, goes without."""

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.vocab_size = size
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.lower = False
        self.split = self._pattern(spec)
        self.odd = re.compile("[^\x00-\xff]")
        # whether a token is looked for before or after the normalizer is the library's business: any letter case goes there
        self.added = [] if special_as_text else [t["content"].lower() if self.lower else t["content"] for t in spec["added_tokens"]]
        self.known = _Known(self.whole.model, self.dtype)

    def _pattern(self, spec: dict) -> re.Pattern | None:
        """The split pattern of a tokenizer shape known here, else None."""
        model, pre, norm = spec["model"], spec["pre_tokenizer"] or {}, spec["normalizer"]
        if model["type"] != "BPE" or not all(t["special"] for t in spec["added_tokens"]):
            return None
        other = f"[^{SPACES}{LETTERS}{NUMBERS}]+"
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
            return re.compile(f" ?[{LETTERS}]+| ?[{NUMBERS}]+|{CONTRACTIONS}| ?{other}|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
        parts = pre.get("pretokenizers", [])
        if (
            [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]
            and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        ):
            self.lower = True  # Latin-1 text is in NFC already, and its lower case stays in Latin-1
            return re.compile(f"[{LETTERS}]+|[{NUMBERS}]|{CONTRACTIONS}|{other}")
        return None

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian integers of ``dtype``."""
        plain = text.lower() if self.lower else text
        if self.split is None or self.odd.search(text) or any(t in plain for t in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return b"".join(map(self.known.__getitem__, self.split.findall(plain)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; it outlives a task."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path, special_as_text=False)
    return _encoders[path]
