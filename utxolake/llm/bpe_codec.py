"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is the BPE encoding of a word exactly if every token encodes to
itself and every two neighbours are compatible: no merge across their seam would have
come before the merges that made them. An Aho-Corasick automaton finds the longest token
at each place of a word; the encoder takes it if it is compatible with the token before,
else the next shorter one, and steps back where none is left. A place left behind is
never entered again, so the work is linear in the word.

Words are what the vocabulary file's own normalizer and pre-tokenizer make of a text:
on Latin-1 texts by the pattern of ``pretokens``, on others by the library's. Special
tokens' strings in a text are those tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import text_or_empty
from utxolake.llm.pretokens import Encoder, _byte_symbols, _latin1_symbols

#: Pairs and words a worker remembers at most; past it the memory is dropped and filled anew.
REMEMBERED_PAIRS, REMEMBERED_WORDS = 1 << 18, 1 << 19
#: Longer words are encoded but not remembered.
LONGEST = 48
#: Ids per batch handed back to Spark, or one document.
BATCH_IDS = 1 << 18
#: A word's last symbol stands this far up in the automaton's alphabet where the vocabulary marks word ends.
END = 0x10000


class Merges:
    """The vocabulary as symbol strings, merge ranks and the merge that made each token."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain BPE model")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.suffix = bool(suffix)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        strings: dict[int, str] = {}
        for token, i in vocab.items():
            if len(token) == 1:
                strings[i] = token
            elif suffix and len(token) == 1 + len(suffix) and token.endswith(suffix):
                strings[i] = chr(ord(token[0]) + END)
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in self.made or left not in strings or right not in strings:
                raise ValueError("a merge without its parts, or a token made twice")
            strings[whole] = strings[left] + strings[right]
            self.made[whole] = (r, left, right)
            self.rank[left, right] = r
        good: dict[int, bool] = {}
        for t in strings:  # in order of ids; merges come after their parts
            if t not in self.made:
                good[t] = True
        for t, (r, left, right) in self.made.items():
            good[t] = good[left] and good[right] and self.seam_holds(left, right, r)
        self.strings = {t: s for t, s in strings.items() if good[t]}

    def seam_holds(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether no merge joins the two sides of the seam between ``a`` and ``b`` before rank ``until``.

        The neighbours at the seam are followed back in time: the one made last is undone first. Of equal ranks
        the left place merges first, so a merge of the seam at the rank that made its left side comes too late
        and one at the rank that made its right side comes first.
        """
        rank, made = self.rank, self.made
        while True:
            r = rank.get((a, b))
            if r is not None and (until is None or r < until):
                return False
            of_a, of_b = made.get(a), made.get(b)
            if of_a is None and of_b is None:
                return True
            if of_b is None or (of_a is not None and of_a[0] > of_b[0]):
                until, a = of_a[0], of_a[2]
            else:
                until, b = of_b[0] + 1, of_b[1]


class _Words(dict):
    """Word -> little-endian ids, filled as words are met."""

    def __init__(self, encode, dtype):
        self.encode, self.dtype = encode, dtype

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(word), dtype=self.dtype).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class BacktrackingEncoder:
    """Of one vocabulary file of the tokenizers library: a BPE model over byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["post_processor"] not in (None, {}) and spec["post_processor"]["type"] != "ByteLevel":
            raise ValueError("a post-processor that adds tokens")
        if not all(t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"]):
            raise ValueError("added tokens other than plain special ones")
        self.prepare(spec["model"])
        helper = Encoder(path, special_as_text=False)  # for its split pattern only
        self.whole, self.split, self.lower, self.odd, self.dtype = helper.whole, helper.split, helper.lower, helper.odd, helper.dtype
        self.special = {t["content"]: np.array([t["id"]], self.dtype).tobytes() for t in spec["added_tokens"]}
        self.at_special = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True))) if self.special else None
        symbols = _latin1_symbols()
        self.latin = _Words(lambda word: self.word_ids(word.translate(symbols)), self.dtype)
        self.other = _Words(self.word_ids, self.dtype)

    def prepare(self, model: dict) -> None:
        """Automaton, next shorter tokens, and an empty table of pairs."""
        self.merges = Merges(model)
        self.size = {t: len(s) for t, s in self.merges.strings.items()}
        self.automaton = ahocorasick.Automaton()
        for t, s in self.merges.strings.items():
            self.automaton.add_word(s, t)
        self.automaton.make_automaton()
        by_string = {s: t for t, s in self.merges.strings.items()}
        self.shorter = {t: next((by_string[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_string), None) for s, t in by_string.items()}
        self.pairs: dict[int, bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        pair = a << 32 | b
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self.merges.seam_holds(a, b)
        return known

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token, given in byte symbols."""
        n = len(word)
        if not n:
            return []
        if self.merges.suffix:
            word = word[:-1] + chr(ord(word[-1]) + END)
        size, shorter = self.size, self.shorter
        longest: list[int | None] = [None] * (n + 1)
        for last, t in self.automaton.iter(word):  # longer ones of a start come later
            longest[last + 1 - size[t]] = t
        out, at, t, left = [], 0, longest[0], bytearray(n + 1)
        while at < n:
            if t is None:
                if not out:
                    raise ValueError("a symbol that the vocabulary lacks")
                left[at] = 1
                t = out.pop()
                at -= size[t]  # its end is left now, so that the next step shortens it
            elif not left[at + size[t]] and (not out or self.compatible(out[-1], t)):
                out.append(t)
                at += size[t]
                t = longest[at]
            else:
                t = shorter[t]
        return out

    def _segment(self, text: str) -> bytes:
        if self.split is not None and not self.odd.search(text):
            return b"".join(map(self.latin.__getitem__, self.split.findall(text.lower() if self.lower else text)))
        plain = self.whole.normalizer.normalize_str(text) if self.whole.normalizer else text
        return b"".join([self.other[word] for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(plain)])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian integers of ``dtype``."""
        if self.at_special is None or not self.at_special.search(text):
            return self._segment(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [self._segment(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return b"".join([*out, self._segment(text[at:])])


class OffsetTable:
    """All tokens' strings in one buffer with offsets; ids decode by gathering their ranges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        decoder = spec["decoder"]
        if decoder is not None and decoder["type"] != "ByteLevel":
            raise ValueError("a decoder other than none or ByteLevel")
        self.gap = b" " if decoder is None else b""  # without a decoder the library sets blanks between tokens
        strings = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        byte_of = {s: bytes([b]) for b, s in _byte_symbols().items()}
        parts = []
        for i in range(max(strings, default=-1) + 1):
            token = strings.get(i)
            if token is None:
                parts.append(b"")
            elif decoder is not None and all(c in byte_of for c in token):
                parts.append(b"".join(byte_of[c] for c in token))
            else:
                parts.append(token.encode() + self.gap)
        self.table = pa.array(parts, pa.large_binary())

    def decode(self, ids: pa.Array, ends: np.ndarray) -> list[str]:
        """Texts of consecutive id lists; list i ends before id ``ends[i]``. Ids outside the vocabulary are left out, as in the library."""
        flat = ids.to_numpy(zero_copy_only=False)
        known = (flat >= 0) & (flat < len(self.table))
        if not known.all():
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            flat = flat[known]
        taken = self.table.take(pa.array(flat))
        _, offsets, data = taken.buffers()
        if not len(flat):
            return [""] * len(ends)
        to = np.frombuffer(offsets, np.int64, len(flat) + 1)[ends]
        view, begin, out = memoryview(data) if data is not None else b"", 0, []
        for end in to.tolist():
            own = bytes(view[begin:end])
            out.append((own[: -len(self.gap)] if self.gap else own).decode("utf-8", "replace"))
            begin = end
        return out


_encoders: dict[str, BacktrackingEncoder] = {}
_tables: dict[str, OffsetTable] = {}


def _kept(kept: dict, make, path: str):
    """The worker's copy for one vocabulary file; it outlives a task."""
    if path not in kept:
        kept.clear()
        kept[path] = make(path)
    return kept[path]


def encode(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """Per row: id and ``ids`` (array of int), those of ``encode(text, add_special_tokens=False)`` without truncation or padding.

    ``with_decoded`` adds ``decoded``, the text that ``decode`` gives for the ids, without a second pass through Python. A null text counts as empty, which has no ids. Null and repeated ids keep their rows; extra columns are
    ignored; an empty table gives no rows. Vocabulary files whose model isn't plain BPE over byte symbols are refused.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] + [T.StructField("decoded", T.StringType())] * with_decoded)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _kept(_encoders, BacktrackingEncoder, tokenizer)
        table = _kept(_tables, OffsetTable, tokenizer) if with_decoded else None
        kind = pa.list_(pa.field("element", pa.int32(), False))
        for batch in batches:
            first, parts, held = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                parts.append(enc.encode(text.as_py()))
                held += len(parts[-1]) // enc.dtype.itemsize
                if held >= BATCH_IDS or i + 1 == batch.num_rows:
                    ends = np.cumsum([0, *(len(p) // enc.dtype.itemsize for p in parts)]).astype(np.int32)
                    flat = pa.array(np.frombuffer(b"".join(parts), enc.dtype).astype(np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(ends), flat, type=kind)
                    decoded = [] if table is None else [pa.array(table.decode(flat, ends[1:]), pa.string())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i + 1 - first), lists, *decoded], names=schema.names)
                    first, parts, held = i + 1, [], 0

    return docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text")).mapInArrow(task, schema)


def decode(ids: Column, tokenizer: str) -> Column:
    """The text of a column of id lists, as ``decode(ids, skip_special_tokens=False)``; null: empty."""

    def texts(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _kept(_tables, OffsetTable, tokenizer)
        for batch in lists:
            out, first = [], 0
            lengths = np.cumsum(batch.value_lengths().to_numpy(zero_copy_only=False))
            while first < len(batch):  # BATCH_IDS ids at a time, or one list
                before = lengths[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(lengths, before + BATCH_IDS)))
                out.append(pa.array(table.decode(batch.slice(first, last - first).flatten(), lengths[first:last] - before), pa.string()))
                first = last
            yield pa.chunked_array(out, pa.string()).combine_chunks() if out else pa.array([], pa.string())

    return F.arrow_udf(texts, T.StringType())(F.coalesce(ids, F.array().cast("array<int>")))
