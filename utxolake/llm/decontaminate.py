"""Benchmark decontamination by Wu-Manber search over words.

Words are the symbols of the search. The test strings are the windows of
``WINDOW`` consecutive words of each benchmark item; an item of fewer words is one
window. Strings of one length form a class with its own tables: over the blocks
(two neighbouring words) of its strings, ``shift`` says how far the search may
advance past a block, unlisted blocks allow the largest advance, and a block of
shift 0 opens the bucket of the strings that end with it, which are then compared
directly.

The tables of one benchmark block are broadcast; a block holds at most
``BLOCK_BYTES`` of item text. A larger benchmark is searched block by block,
the state of each document stored in between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import stored, text_or_empty

WINDOW = 10
#: Benchmark text whose search tables a task holds at once.
BLOCK_BYTES = 8 << 20

_WORD = np.array([chr(b).isascii() and (chr(b).isalnum()) or b >= 0x80 for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def split_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words (runs of ASCII letters, digits and non-ASCII characters; A-Z in lower case)
    each followed by one space, and where each begins and ends."""
    raw = np.frombuffer(text, dtype=np.uint8)
    word = _WORD[raw]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the byte after a word, as a space
    flat = np.where(word, _LOWER[raw], 32).astype(np.uint8)[keep]
    if len(word) and word[-1]:
        flat = np.append(flat, np.uint8(32))
    ends = np.flatnonzero(flat == 32)
    starts = np.concatenate([np.zeros(1, ends.dtype), ends[:-1] + 1])[: len(ends)]
    return flat.tobytes(), starts, ends


class Tables:
    """Search tables of one class: strings of ``m`` words."""

    def __init__(self, strings: dict[bytes, list[int]], m: int):
        self.m, self.block = m, min(2, m)
        self.most = m - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[int]]] = {}
        for string, items in strings.items():
            words = string.split(b" ")
            for end in range(self.block, m + 1):
                block = b" ".join(words[end - self.block : end])
                self.shift[block] = min(self.shift.get(block, self.most), m - end)
            self.buckets.setdefault(block, {})[string] = items

    def find(self, flat: bytes, starts: list[int], ends: list[int]) -> Iterator[tuple[int, list[int]]]:
        """(first word, items) of every occurrence."""
        shift, buckets, most, m, back = self.shift.get, self.buckets, self.most, self.m, self.block - 1
        at, n = m - 1, len(ends)
        while at < n:
            block = flat[starts[at - back] : ends[at]]
            step = shift(block, most)
            if step:
                at += step
                continue
            first = at - m + 1
            items = buckets[block].get(flat[starts[first] : ends[at]])
            if items is not None:
                yield first, items
            at += 1


def build(items: list[tuple[str, str]], window: int = WINDOW) -> tuple[list[str], list[Tables]]:
    """Item names and the tables of each class. ``items``: (name, text)."""
    names = sorted({name for name, _ in items})
    no = {name: i for i, name in enumerate(names)}
    classes: dict[int, dict[bytes, set[int]]] = {}
    for name, text in items:
        flat, starts, ends = split_words(text.encode("utf-8", "surrogatepass"))
        m = min(window, len(ends))
        for i in range(len(ends) - m + 1 if m else 0):
            classes.setdefault(m, {}).setdefault(flat[starts[i] : ends[i + m - 1]], set()).add(no[name])
    return names, [Tables({s: sorted(v) for s, v in strings.items()}, m) for m, strings in sorted(classes.items())]


def search(flat: bytes, starts: np.ndarray, ends: np.ndarray, tables: list[Tables]) -> tuple[np.ndarray, set[int]]:
    """Which words lie inside an occurrence, and the items found."""
    cover = np.zeros(len(ends) + 1, dtype=np.int64)
    found: set[int] = set()
    starts_l, ends_l = starts.tolist(), ends.tolist()
    for t in tables:
        for first, items in t.find(flat, starts_l, ends_l):
            cover[first] += 1
            cover[first + t.m] -= 1
            found.update(items)
    return np.cumsum(cover)[:-1] > 0, found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), text_or_empty(F.col(text_col)).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    return [items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == b) for b in range(n)] if n > 1 else [items]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated, and hit_spans
    (first and one past the last word of each maximal hit run) and items (found names, sorted as strings).

    Null texts have no words; a null item id is named by the empty string; items that
    share an id are one item. Rows with equal or null ids are judged each on its own.
    An empty benchmark contaminates nothing. Extra columns of either table are ignored.
    """
    spark = docs.sparkSession
    state = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType())),
    ])
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    rows = rows.select("id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks = _blocks(benchmark, item_col, "text", block_bytes)
    for i, block in enumerate(blocks):
        built = spark.sparkContext.broadcast(build([(r["name"], r["text"]) for r in block.collect()], window))
        last = i == len(blocks) - 1

        def task(batches: Iterator[pa.RecordBatch], built=built, last=last) -> Iterator[pa.RecordBatch]:
            names, tables = built.value
            for batch in batches:
                ids, texts, _, spans, items = (batch.column(c) for c in range(5))
                out_n, out_spans, out_items = [], [], []
                for text, old_spans, old_items in zip(texts, spans.to_pylist(), items.to_pylist(), strict=True):
                    flat, starts, ends = split_words(text.as_buffer().to_pybytes())
                    hit, found = search(flat, starts, ends, tables)
                    for lo, hi in zip(old_spans[::2], old_spans[1::2], strict=True):
                        hit[lo:hi] = True
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                    out_n.append(len(ends))
                    out_spans.append(edges.tolist())
                    out_items.append(sorted({names[i] for i in found} | set(old_items)))
                kept = pa.array([""] * len(texts), texts.type) if last else texts
                yield pa.RecordBatch.from_arrays(
                    [ids, kept, pa.array(out_n, pa.int64()), pa.array(out_spans, pa.list_(pa.int64())), pa.array(out_items, pa.list_(pa.string()))], names=state.names,
                )

        rows = rows.mapInArrow(task, state)
        if not last:
            rows = stored(rows, "decontaminate")
    odd, even = (F.expr(f"aggregate(filter(spans, (x, i) -> i % 2 = {r}), 0L, (a, x) -> a + x)") for r in (1, 0))
    n_hit = odd - even
    return rows.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.col("spans").alias("hit_spans"), "items",
    )


def is_contaminated(text: str, tables: list[Tables]) -> bool:
    """Whether any window occurs in one text."""
    flat, starts, ends = split_words((text or "").encode("utf-8", "surrogatepass"))
    return bool(search(flat, starts, ends, tables)[1])


def _clean(built):
    """A column function: whether no window of the broadcast tables occurs."""

    @F.pandas_udf(T.BooleanType())
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not is_contaminated(t, built.value) for t in texts], dtype=bool)

    return clean


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item. All columns are kept."""
    spark = docs.sparkSession
    kept = docs
    blocks = _blocks(benchmark, item_col, "text", block_bytes)
    for i, block in enumerate(blocks):
        built = spark.sparkContext.broadcast(build([(r["name"], r["text"]) for r in block.collect()], window)[1])
        kept = kept.where(_clean(built)(text_or_empty(F.col(f"`{text_col}`"))))
        if i < len(blocks) - 1:
            kept = stored(kept, "decontaminate")
    return kept
