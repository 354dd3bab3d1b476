"""Token-ID output as Re-Pair grammars with random access.

Documents are dealt by range of id and sorted, so that shard, block and
position follow the ascending ids. Each task encodes its documents and writes
blocks of ``BLOCK_TOKENS`` tokens or a little more. In a block, pairs of
neighbouring symbols that occur often are replaced by nonterminals, the most
frequent first (all pairs within a factor of two of the most frequent one in one
vectorised round), until no pair occurs ``MIN_COUNT`` times.

A block is one Parquet row:
``shard, block, start`` (tokens of the shard before it), ``n_tokens``,
``doc_ids``, ``doc_starts`` (token positions in the block), and ``payload``:
magic ``RPG1``; unsigned 32-bit counts of terminals, rules and sequence symbols
and the byte width of symbols (2 or 4); then the terminals (ids, 32 bit), the
rules' left and right symbols (32 bit), the rules' expansion lengths (32 bit),
and the sequence. Symbols below the terminal count are positions in the terminal
list; the others are rules in order. Integers are little-endian.
``read_tokens`` decodes any range of a block from the symbols that cover it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import shared_path, text_or_empty
from utxolake.llm.pretokens import encoder

BLOCK_TOKENS = 1 << 20
MIN_COUNT = 12
MAGIC = b"RPG1"
_BITS = 20


def _replaceable(at: np.ndarray) -> np.ndarray:
    """Of sorted positions, those kept when pairs that share a symbol exclude each other, left first."""
    if not len(at):
        return at
    breaks = np.flatnonzero(np.diff(at) != 1) + 1
    run_start = np.zeros(len(at), dtype=np.int64)
    run_start[breaks] = breaks
    np.maximum.accumulate(run_start, out=run_start)
    return at[(np.arange(len(at)) - run_start) % 2 == 0]


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA77))) >> np.uint32(32 - _BITS)


def _count(by: np.ufunc, slots: np.ndarray, at: np.ndarray) -> None:
    if len(at) < len(slots) >> 3:
        by.at(slots, at, 1)
    else:
        by(slots, np.bincount(at, minlength=len(slots)), out=slots)


def _shortened(seq: np.ndarray, slot: np.ndarray, slots: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence without the places after ``keep``, whose symbols are new, and its pairs' slots. Only pairs next
    to a change leave and enter the counts of ``slots``."""
    stays, changed = np.ones(len(seq), bool), np.zeros(len(seq), bool)  # changed: the pair that begins there
    stays[keep + 1] = False
    changed[keep] = changed[keep + 1] = True
    changed[np.maximum(keep - 1, 0)] = True
    _count(np.subtract, slots, slot[changed[:-1]])
    seq, changed = seq[stays], changed[stays][:-1]
    slot = slot[stays[:-1]][: len(seq) - 1]
    at = np.flatnonzero(changed)
    slot[at] = _slots(seq[at], seq[at + 1])
    _count(np.add, slots, slot[at])
    return seq, slot


def compress(ids: np.ndarray, min_count: int = MIN_COUNT) -> bytes:
    """Re-Pair of one block of ids."""
    if len(ids) and int(ids.max()) < 1 << _BITS:  # a table of the ids instead of a sort
        there = np.zeros(int(ids.max()) + 1, bool)
        there[ids] = True
        terminals, seq = np.flatnonzero(there), (np.cumsum(there, dtype=np.uint32) - np.uint32(1))[ids]
    else:
        terminals, seq = np.unique(ids, return_inverse=True)
        seq = seq.astype(np.uint32)
    n_terminals, rules = len(terminals), []
    n_symbols, bound = n_terminals, None
    slot = _slots(seq[:-1], seq[1:])  # of the pair that begins at each place; at least the count of any pair of a slot
    slots = np.bincount(slot, minlength=1 << _BITS)
    while len(seq) > 1:
        most = int(slots.max())
        bound = most if bound is None else min(most, bound)
        least = max(min_count, bound // 2)
        if most < min_count:
            break
        at = np.flatnonzero((slots >= least)[slot])
        pairs = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        order = np.sort(pairs)
        new = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        counts, found = np.diff(np.append(new, len(order))), order[new]
        chosen = np.sort(found[counts >= least])
        bound = least - 1 if not len(chosen) else least
        if len(chosen):
            where = np.minimum(np.searchsorted(chosen, pairs), len(chosen) - 1)
            hit = chosen[where] == pairs
            keep = _replaceable(at[hit])
            rule_of = where[hit][np.searchsorted(at[hit], keep)]
            rules.append(chosen)
            seq[keep] = (n_symbols + rule_of).astype(np.uint32)
            n_symbols += len(chosen)
            seq, slot = _shortened(seq, slot, slots, keep)
        elif least == min_count:
            break  # pairs with new nonterminals have been looked at too
    flat = np.concatenate(rules) if rules else np.zeros(0, np.uint64)
    left, right = (flat >> np.uint64(32)).astype("<u4"), (flat & np.uint64(0xFFFFFFFF)).astype("<u4")
    length = np.ones(n_symbols, dtype=np.int64)
    done = n_terminals
    for r in rules:  # rules of a round use symbols of earlier rounds only
        i = slice(done - n_terminals, done - n_terminals + len(r))
        length[done : done + len(r)] = length[left[i]] + length[right[i]]
        done += len(r)
    width = 2 if n_symbols <= 1 << 16 else 4
    head = np.array([n_terminals, len(flat), len(seq), width], dtype="<u4").tobytes()
    return b"".join([MAGIC, head, terminals.astype("<u4").tobytes(), left.tobytes(), right.tobytes(), length[n_terminals:].astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes()])


class Block:
    """A payload opened for reading."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a Re-Pair block")
        n_terminals, n_rules, n_seq, width = (int(x) for x in np.frombuffer(payload, "<u4", 4, 4))
        at = 20
        self.terminals = np.frombuffer(payload, "<u4", n_terminals, at)
        at += 4 * n_terminals
        self.left, self.right, lengths = (np.frombuffer(payload, "<u4", n_rules, at + 4 * n_rules * i) for i in range(3))
        self.seq = np.frombuffer(payload, f"<u{width}", n_seq, at + 12 * n_rules)
        self.length = np.concatenate([np.ones(n_terminals, np.int64), lengths.astype(np.int64)])
        self.ends = np.cumsum(self.length[self.seq])
        self.n_tokens = int(self.ends[-1]) if n_seq else 0

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        n = len(self.terminals)
        symbols = symbols.astype(np.int64)
        while len(inner := np.flatnonzero(symbols >= n)):
            rule = symbols[inner] - n
            wide = np.repeat(symbols, 1 + (symbols >= n))
            first = inner + np.arange(len(inner))
            wide[first], wide[first + 1] = self.left[rule], self.right[rule]
            symbols = wide
        return self.terminals[symbols]

    def read_tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block, decoding only the symbols that cover them."""
        start, stop = max(0, start), min(stop, self.n_tokens)
        if start >= stop:
            return np.zeros(0, "<u4")
        lo, hi = np.searchsorted(self.ends, [start, stop - 1], side="right")
        before = int(self.ends[lo]) - int(self.length[self.seq[lo]])
        return self._expand(self.seq[lo : hi + 1])[start - before : stop - before]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 1, block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, under ``path``.

    A null text counts as empty. Null ids come first, rows with equal ids follow
    each other in the order of their texts' hash and text. Extra columns are ignored.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("block", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)),
        T.StructField("doc_starts", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        block, before, ids, starts, parts, n, kind = 0, 0, [], [], [], 0, None
        end = enc.dtype.type(end_id).tobytes()

        def flush() -> pa.RecordBatch:
            row = [[shard], [block], [before], [n], [ids], [starts], [compress(np.frombuffer(b"".join(parts), enc.dtype))]]
            types = [pa.int64()] * 4 + [pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = enc.encode(text) + end
                ids.append(doc)
                starts.append(n)
                parts.append(own)
                n += len(own) // enc.dtype.itemsize
                if n >= block_tokens:
                    yield flush()
                    block, before, ids, starts, parts, n = block + 1, before + n, [], [], [], 0
        if ids:
            yield flush()

    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    rows.mapInArrow(task, schema).write.parquet(path)


def read_documents(docs: DataFrame | None, path: str, spark, id_col: str = "doc_id") -> DataFrame:
    """Per document, decoded from the files: id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``docs`` only gives the id's type. Starts come from one row per shard.
    """
    blocks = spark.read.parquet(path)
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField(id_col, id_type)] + [T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, before, n, doc_ids, starts, payload = (batch.column(c)[i] for c in range(6))
                block, starts = Block(payload.as_buffer().to_pybytes()), np.array(starts.values, dtype=np.int64)
                ends = np.append(starts[1:], n.as_py())
                whole = block.read_tokens(0, block.n_tokens)
                crcs = [zlib.crc32(whole[lo:hi].astype("<u4").tobytes()) for lo, hi in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), shard.as_py())), doc_ids.values, pa.array(starts + before.as_py()), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    names=schema.names,
                )

    rows = blocks.select("shard", "start", "n_tokens", "doc_ids", "doc_starts", "payload").mapInArrow(task, schema)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "shard", "left").select(id_col, (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the files (to ``path`` or a fresh shared folder) and read them back. An empty table gives no rows."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-ids")
    write_token_files(docs, path, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id)
    return read_documents(docs, path, spark, id_col)
