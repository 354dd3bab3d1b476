"""Packing of token sequences: best-fit decreasing over a segment tree of capacities.

Overlong documents are first cut into full windows. What is left of each is
packed by decreasing length into the tightest open window: a segment tree,
indexed by remaining capacity, counts the open windows and finds the smallest
capacity that is large enough in log2(window) steps. Windows that stay partly
empty are then topped up with cut pieces of the emptiest ones, and the last one
is laid out as sequences of power-of-two length, which need no padding.

Packing runs inside the tasks that encode the documents, one shard at a time
(``SHARD_TOKENS`` tokens of rests at most), so no text and no id is shuffled and
memory doesn't follow the partition's size. A task that runs again repeats its
own sequences: rests are ordered by length, document and start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import text_or_empty
from utxolake.llm.pretokens import encoder

WINDOW = 1024
#: Tokens of document rests packed together.
SHARD_TOKENS = 8_000_000


class OpenWindows:
    """Open windows by remaining capacity; the tree holds counts."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window_no: int) -> None:
        self.stacks[capacity].append(window_no)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest one that holds ``least``."""
        count, node = self.count, self.leaves + least
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.stacks[capacity].pop()


def pack_rests(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, from, to) that hold every item once; ``lengths`` below ``window``.

    Every sequence but those of the last window is full; these have power-of-two lengths.
    """
    open_windows, bins, fill = OpenWindows(window), [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        if not n:
            continue
        found = open_windows.take(n)
        if found is None:
            found = (window, len(bins))
            bins.append([])
            fill.append(0)
        capacity, b = found
        bins[b].append((item, 0, n))
        fill[b] += n
        if capacity > n:
            open_windows.put(capacity - n, b)
    partly = sorted((b for b in range(len(bins)) if fill[b] < window), key=lambda b: (-fill[b], b))
    i, j = 0, len(partly) - 1
    while i < j:
        b, donor = partly[i], bins[partly[j]]
        gap = window - fill[b]
        item, lo, hi = donor.pop()
        part = min(gap, hi - lo)
        bins[b].append((item, lo, lo + part))
        fill[b] += part
        fill[partly[j]] -= part
        if lo + part < hi:
            donor.append((item, lo + part, hi))
        if not donor:
            j -= 1
        if fill[b] == window:
            i += 1
    out = [pieces for pieces in bins if pieces]
    if i == j and 0 < fill[partly[i]] < window:
        out.remove(last := bins[partly[i]])
        out += _powers_of_two(last, fill[partly[i]])
    return out


def _powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    out, left = [], list(pieces)
    for bit in reversed(range(total.bit_length())):
        need, seq = total & (1 << bit), []
        while need:
            item, lo, hi = left.pop(0)
            part = min(need, hi - lo)
            seq.append((item, lo, lo + part))
            need -= part
            if lo + part < hi:
                left.insert(0, (item, lo + part, hi))
        if seq:
            out.append(seq)
    return out


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class _Rows:
    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows = []
        return out


def pack(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's, by the vocabulary file ``tokenizer``, and ``end_id``;
    each lies in exactly one piece. A null text counts as empty: one piece, the end id.
    Rows with equal or null ids are packed each on its own. Other columns play no part.
    ``with_ids`` adds the ids (binary, little-endian unsigned 32 bit).
    An empty table gives no rows. ``sequence_id`` is unique, not consecutive.
    """
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)
    shard_tokens = SHARD_TOKENS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 32
        seq, rests, held, out = 0, [], 0, None

        def piece(doc, start, ids, n, seq, offset):
            out.rows.append((doc, start, len(ids), _crc(ids), n, first + seq, offset) + ((ids.astype("<u4").tobytes(),) if with_ids else ()))

        def flush():
            nonlocal seq, rests, held
            rests.sort(key=lambda r: (-len(r[2]), r[0] is None, r[0] if r[0] is not None else 0, r[1]))
            for pieces in pack_rests([len(r[2]) for r in rests], window):
                offset = 0
                for item, lo, hi in pieces:
                    doc, start, ids, n = rests[item]
                    piece(doc, start + lo, ids[lo:hi], n, seq, offset)
                    offset += hi - lo
                seq += 1
            rests, held = [], 0

        for batch in batches:
            if out is None:
                out = _Rows(pa.schema([pa.field(id_col, batch.schema.field(0).type), *(pa.field(f.name, pa.int64()) for f in fields[1:]), *([pa.field("ids", pa.binary())] * with_ids)]))
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(np.frombuffer(enc.encode(text), dtype=enc.dtype), enc.dtype.type(end_id))
                n = len(ids)
                for start in range(0, n - window + 1, window):
                    piece(doc, start, ids[start : start + window], n, seq, 0)
                    seq += 1
                if n % window:
                    rests.append((doc, n - n % window, ids[n - n % window :].copy(), n))
                    held += n % window
                if held >= shard_tokens:
                    flush()
                if len(out.rows) >= 20_000:
                    yield out.batch()
        if out is not None:
            flush()
            yield out.batch()

    return docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text")).mapInArrow(task, schema)
