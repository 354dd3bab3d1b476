"""Removal of repeated byte strings by suffix arrays over shards.

A string of ``length`` bytes is represented by its smallest 48-byte gram (by hash, the
first among equals), so equal strings share the gram and its place in them. Strings
of one text with the same representative are neighbours; they form a run, whose
context is the bytes that they cover.

1. Grams that represent two runs or more are found by counting their hashes.
2. Runs of such grams are kept. If all contexts of a gram are equal, every string of its runs
   is repeated.
3. Of the others, one copy of each context goes, by gram, into shards. A suffix array of the shard's
   contexts, built by induced sorting, and its permuted common prefixes show which strings
   start more than once. Grams of more than ``HOT_RUNS`` runs, which could fill a shard, first have
   their runs cut into parts with longer keys (``_refined``).
4. The removed bytes of a text are the union of its repeated strings.

Texts are known by two 64-bit hashes in the joins; copies of a text share all results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import stored, text_or_empty
from utxolake.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH, GRAM = 200, 48
HOT_RUNS = 2000
PART = 16
SHARD_BYTES = 1 << 20
#: Bits of the filter that keeps unrepeated grams out of the join; a fixed size, and only a filter.
FILTER_BITS = 1 << 28
SEGMENT = 1 << 17

_MUL = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(SEGMENT + (1 << 14), _MUL, np.uint64)]), dtype=np.uint64)
_INVERSE = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(SEGMENT + (1 << 14), pow(_MUL, -1, 1 << 64), np.uint64)]), dtype=np.uint64)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _INVERSE[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _POWERS[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _segment_runs(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First string, number of strings, gram hash and the gram's place of each run."""
    width = length - gram + 1  # grams in a string
    h = _gram_hashes(raw, gram)
    place = np.uint64((1 << 18) - 1)
    v = (h & ~place) | np.arange(len(h), dtype=np.uint64)  # by hash, then place
    blocks = np.concatenate([v, np.full(-len(v) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    at = (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & place).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    return first, np.diff(np.append(first, n)), h[at[first]], at[first]


def runs(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string, number of strings, gram hash) of all runs of a text; long texts by segments of strings."""
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    raw = np.frombuffer(text, np.uint8)
    parts = []
    for at in range(0, n, SEGMENT):
        first, count, h, _ = _segment_runs(raw[at : min(at + SEGMENT, n) + length - 1], length, gram)
        parts.append((first + at, count, h))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _text_key(text) -> list:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def _run_rows(docs: DataFrame, length: int, gram: int, bits=None) -> DataFrame:
    """(key, ctx, t1, t2, first, count) of the runs whose gram passes the filter ``bits``."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "ctx", "t1", "t2")] + [T.StructField(n, T.IntegerType()) for n in ("first", "count")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        keep = None if bits is None else np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            held = 0

            def flush():
                cols = [np.concatenate(c) for c in out]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=schema.names)

            for text, t1, t2 in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text.as_buffer().to_pybytes()
                first, count, h = runs(text, length, gram)
                if keep is not None and len(h):
                    slot = h & np.uint64(FILTER_BITS - 1)
                    ok = (keep[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    first, count, h = first[ok], count[ok], h[ok]
                if not len(h):
                    continue
                ends = (first + count + length - 1).tolist()
                ctx = np.fromiter((digest(text[a:b]) for a, b in zip(first.tolist(), ends, strict=True)), np.uint64, len(h))
                for c, x in zip(out, (h.view(np.int64), ctx.view(np.int64), np.full(len(h), t1), np.full(len(h), t2), first.astype(np.int32), count.astype(np.int32)), strict=True):
                    c.append(x)
                held += len(h)
                if held > 100_000:
                    yield flush()
                    out, held = [[] for _ in range(6)], 0
            if held:
                yield flush()

    text = text_or_empty(F.col("text"))
    return docs.select(text.alias("text"), *_text_key(text)).where(F.octet_length("text") >= length).mapInArrow(task, schema)


def _filter(repeated: DataFrame) -> bytes:
    """A bit for each kept gram hash: ``FILTER_BITS`` / 8 bytes, whatever the input."""
    page = 1 << 15
    slot = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    pages = repeated.select(F.shiftright(slot, 15).cast("int").alias("page"), slot.bitwiseAND(F.lit(page - 1)).alias("bit"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in pages.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r["page"] * page // 8 : (r["page"] + 1) * page // 8] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def repeated_strings(contexts: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """Flags of each context's strings that start more than once in the shard, where a context stands for
    several of its kind if its count says so."""
    size = 258  # end mark, mark after a context, bytes
    t = np.zeros(sum(map(len, contexts)) + len(contexts) + 1, np.int16)
    starts, at = [], 0
    for c in contexts:
        t[at : at + len(c)] = np.frombuffer(c, np.uint8).astype(np.int16) + 2
        t[at + len(c)] = 1
        starts.append(at)
        at += len(c) + 1
    sa = suffix_array(t, size)
    joined = np.flatnonzero(permuted_common_prefixes(t, sa, length) >= length)  # equals the string before it
    before = np.empty(len(t), np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    twice = np.zeros(len(t), bool)
    twice[joined] = True
    twice[before[joined]] = True
    return [np.ones(len(c) - length + 1, bool) if n > 1 else twice[s : s + len(c) - length + 1] for c, s, n in zip(contexts, starts, counts, strict=True)]


def _ranges(flags: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).tolist()


_RESULT = T.StructType([T.StructField("key", T.LongType()), T.StructField("ctx", T.LongType()), T.StructField("ranges", T.ArrayType(T.LongType()))])


def _sharded(contexts: DataFrame, length: int) -> DataFrame:
    total = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1

    def shard(table: pa.Table) -> pa.Table:
        flags = repeated_strings(table.column("bytes").to_pylist(), table.column("n").to_pylist(), length)
        ranges = pa.array([_ranges(f) for f in flags], pa.list_(pa.int64()))
        return pa.table({"key": table.column("key"), "ctx": table.column("ctx"), "ranges": ranges})

    return contexts.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInArrow(lambda table: shard(table), _RESULT)


def _one_of_each(contexts: DataFrame) -> DataFrame:
    return contexts.groupBy("key", "ctx").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes"))


def _refined(contexts: DataFrame, length: int, gram: int, hot_runs: int) -> DataFrame:
    """The same for grams of very many contexts. Their runs are cut into parts of ``PART`` strings at most, by
    the gram's place in a string; all strings of a part share a core of nearly ``length`` bytes, whose hash
    is the part's new key. Few keys repeat, and fewer are mixed; these go into shards, or, if one is
    still too frequent, their strings are counted."""
    part = min(PART, length)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("of_key", "of_ctx", "n", "at", "key", "ctx")] + [T.StructField("bytes", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for lo in range(0, batch.num_rows, 5000):
                rows = []
                for key, ctx, n, text in zip(*(batch.column(c).slice(lo, 5000).to_pylist() for c in range(4)), strict=True):
                    anchor = int(_segment_runs(np.frombuffer(text, np.uint8), length, gram)[3][0])
                    last = len(text) - length
                    for j in range(max(0, anchor - last) // part, anchor // part + 1):
                        a, b = max(0, anchor - part * j - part + 1), min(last, anchor - part * j)
                        core = text[anchor - part * j : anchor - part * j - part + 1 + length]
                        own = text[a : b + length]
                        rows.append((key, ctx, n, a, digest(core, j) - (1 << 63), digest(own) - (1 << 63), own))
                yield _batch(rows, schema)

    parts = stored(contexts.select("key", "ctx", "n", "bytes").mapInArrow(task, schema), "parts")
    counts = parts.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("rows"), F.min("ctx").alias("a"), F.max("ctx").alias("b")).where("total > 1")
    kept = stored(parts.join(counts.select("key", (F.col("a") != F.col("b")).alias("mixed"), (F.col("rows") > hot_runs).alias("hot")), "key"), "parts")
    found = _sharded(_one_of_each(kept.where("mixed and not hot")), length).unionByName(_counted(_one_of_each(kept.where("mixed and hot")), length))
    equal = kept.where("not mixed").select("of_key", "of_ctx", F.array("at", F.col("at") + F.length("bytes") - F.lit(length - 1)).alias("ranges"))
    mixed = kept.where("mixed").drop("n").join(found, ["key", "ctx"]).select("of_key", "of_ctx", F.transform("ranges", lambda x: x + F.col("at")).alias("ranges"))
    both = equal.unionByName(mixed).groupBy("of_key", "of_ctx").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return both.select(F.col("of_key").alias("key"), F.col("of_ctx").alias("ctx"), "ranges")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same by counting each string's 128-bit hash."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "ctx", "n", "at", "h1", "h2")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                texts = rows.column(3).to_pylist()
                n = np.array([len(t) - length + 1 for t in texts])
                row = np.repeat(np.arange(len(texts)), n)
                hashes = np.frombuffer(b"".join(digest(t[a : a + length]) for t, m in zip(texts, n, strict=True) for a in range(m)), np.int64).reshape(-1, 2)
                at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(row)) for c in range(3)), pa.array(at), pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())], names=schema.names)

    strings = stored(contexts.select("key", "ctx", "n", "bytes").mapInArrow(task, schema), "strings")
    twice = strings.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1").select("h1", "h2")
    at = strings.join(twice, ["h1", "h2"]).groupBy("key", "ctx").agg(F.collect_list("at").alias("at"))
    return at.select("key", "ctx", F.flatten(F.transform("at", lambda x: F.array(x, x + 1))).alias("ranges"))


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, ctx, n, hot, bytes): the contexts of ``wanted`` (with one place of each) cut from their texts."""
    by_text = wanted.groupBy(F.col("place.t1").alias("t1"), F.col("place.t2").alias("t2")).agg(F.collect_list(F.struct("key", "ctx", "n", "hot", F.col("place.first").alias("first"), "count")).alias("cuts"))
    texts = _packed(docs, length).dropDuplicates(["t1", "t2"])
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "ctx", "n")] + [T.StructField("hot", T.BooleanType()), T.StructField("bytes", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, held = [], 0
            for text, cuts in zip(batch.column(0), batch.column(1), strict=True):
                text = unpack.decompress(text.as_buffer().to_pybytes())
                for c in cuts.as_py():
                    rows.append((c["key"], c["ctx"], c["n"], c["hot"], text[c["first"] : c["first"] + c["count"] + length - 1]))
                    held += c["count"] + length
                if held > 8 << 20:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, schema)

    return texts.join(by_text, ["t1", "t2"]).select("packed", "cuts").mapInArrow(task, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = {T.LongType: pa.int64(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[type(f.dataType)]) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], names=schema.names)


def _packed(docs: DataFrame, least: int = 0) -> DataFrame:
    """All columns but text, which is compressed for the shuffle, and its key."""
    text = text_or_empty(F.col("text"))
    frame = docs.withColumn("text", text).where(F.octet_length("text") >= least).select(*[c for c in docs.columns if c != "text"], *_text_key(F.col("text")), "text")
    schema = T.StructType([f for f in frame.schema.fields if f.name != "text"] + [T.StructField("packed", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [pack.compress(t.as_buffer().to_pybytes()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=schema.names)

    return frame.mapInArrow(task, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(t1, t2, spans): for each text (by key) of ``docs`` (text) with repeated strings, the byte ranges they cover."""
    spark = docs.sparkSession
    counts = _run_rows(docs, length, gram).groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"))
    grams = stored(counts.where("n > 1").select("key", (F.col("a") != F.col("b")).alias("mixed"), (F.col("n") > hot_runs).alias("hot")), "grams")
    bits = spark.sparkContext.broadcast(_filter(grams))
    kept = stored(_run_rows(docs, length, gram, bits).join(grams, "key"), "runs")
    place = F.struct("t1", "t2", "first")
    wanted = kept.where("mixed").groupBy("key", "ctx", "hot", "count").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    contexts = stored(_contexts(docs, wanted, length), "contexts")
    found = _sharded(contexts.where("not hot"), length).unionByName(_refined(contexts.where("hot"), length, gram, hot_runs))
    found = stored(found.where(F.size("ranges") > 0), "found")
    end = F.lit(length - 1)
    equal = kept.where("not mixed").select("t1", "t2", F.array(F.struct(F.col("first").cast("long").alias("a"), (F.col("first") + F.col("count") + end).cast("long").alias("b"))).alias("s"))
    pairs = F.expr(f"transform(sequence(0, size(ranges) div 2 - 1), i -> struct(first + ranges[2 * i] as a, first + ranges[2 * i + 1] + {length - 1} as b))")
    mixed = kept.where("mixed").join(found, ["key", "ctx"]).select("t1", "t2", pairs.alias("s"))
    return equal.unionByName(mixed).select("t1", "t2", F.explode("s").alias("s")).groupBy("t1", "t2").agg(F.collect_set("s").alias("spans"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed byte ranges) and kept (the bytes left).

    Each byte of a text (UTF-8; null: empty) goes that a string of ``length`` bytes covers which also starts
    elsewhere, in any row. Rows with equal or null ids are documents of their own. Extra columns are
    ignored; an empty table gives no rows.
    """
    gram = min(GRAM, max(1, length // 4))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = repeated_spans(docs.select("text"), length, gram)
    id_type = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type)] + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())] + [T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())] * with_text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, spans in zip(batch.column(1), batch.column(2), strict=True):
                text = unpack.decompress(packed.as_buffer().to_pybytes())
                merged: list[list[int]] = []
                for s in sorted((s["a"], s["b"]) for s in spans.as_py() or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                at, parts = 0, []
                for a, b in merged:
                    parts.append(text[at:a])
                    at = b
                kept = b"".join([*parts, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()) + ((([x for m in merged for x in m]), kept) if with_text else ()))
            types = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64()), pa.binary()] * with_text
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True))], names=schema.names)

    out = _packed(docs).join(spans, ["t1", "t2"], "left").select("id", "packed", "spans").mapInArrow(task, schema)
    return out.withColumnRenamed("id", id_col)
