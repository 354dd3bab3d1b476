"""SimHash near-duplicates by exact comparison of tiles.

A text's fingerprint has a bit set where over half of its shingles' hashes have
it. Copies share a fingerprint and are compared once. Distinct fingerprints are
dealt into tiles by population count (large counts are split by hash into tiles of
``TILE`` at most on average); a pair of tiles meets in one task only if their counts
differ by no more than the radius. Inside, rows are ordered by the population
counts of their four quarters, and a block of rows is compared, by exclusive or and
bit count, only with the rows whose quarters can be that near. A task returns a
spanning forest of its links, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import stored, text_or_empty
from utxolake.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 1 << 17
_ROWS, _COLUMNS = 128, 8192


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one UTF-8 text, unsigned; 0 for a text without words."""
    words = text.lower().split()
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), seed) if words else 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)), np.uint64, n)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` (columns with names) and fp (long: the fingerprint's bits) of every row. Null texts have no words."""
    frame = docs.select(*keys, text_or_empty(F.col(text_col)).alias("__text"))
    schema = T.StructType(frame.schema.fields[:-1] + [T.StructField("fp", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, texts = batch.columns
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*own, pa.array(fps.view(np.int64))], names=schema.names)

    return frame.mapInArrow(task, schema)


class _Forest:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        i = self.root(i)
        for j in np.unique(self.parent[others]).tolist():
            if (j := self.root(j)) != i:
                self.parent[max(i, j)] = i = min(i, j)


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (pairs of fingerprints) of the links between two tiles, or within one (``b`` None)."""
    both = a if b is None else np.concatenate([a, b])
    order = np.lexsort(_quarters(a).T[::-1])
    first, qa = a[order], _quarters(a)[order]
    second, qb, base = (first, qa, 0) if b is None else (b, _quarters(b), len(a))
    forest = _Forest(len(both))
    nodes = np.concatenate([first, second]) if b is not None else first
    for lo in range(0, len(first), _ROWS):
        rows, q = first[lo : lo + _ROWS], qa[lo : lo + _ROWS]
        gap = np.maximum(q.min(axis=0) - qb, 0) + np.maximum(qb - q.max(axis=0), 0)
        near = np.flatnonzero(gap.sum(axis=1) <= radius)
        for at in range(0, len(near), _COLUMNS):
            cols = near[at : at + _COLUMNS]
            hit = np.bitwise_count(rows[:, None] ^ second[cols][None, :]) <= radius
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                others = cols[hit[i]] + base
                if base or len(others) > 1:  # within one tile a row always meets itself
                    forest.join(lo + i, others)
    child = np.flatnonzero(forest.parent != np.arange(len(both)))
    return nodes[child], nodes[forest.parent[child]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v) of a forest that connects what links of ``distinct`` (fp) connect."""
    spark = distinct.sparkSession
    ones = distinct.select("fp", F.bit_count("fp").alias("ones"))
    splits = {r["ones"]: -(-r["n"] // tile) for r in ones.groupBy("ones").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    if not splits:
        return spark.createDataFrame([], "u long, v long")
    n_splits = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(splits.items()) for x in kv]), F.col("ones"))
    tiles = ones.withColumn("part", F.pmod(F.xxhash64("fp"), n_splits).cast("int")).groupBy("ones", "part").agg(F.collect_list("fp").alias("fps"))
    # a tile goes to a task for each tile it may meet: of its own count, and of counts up to the radius away
    others = F.array(*[F.array(*[F.struct(F.lit(o).alias("ones"), F.lit(p).alias("part")) for p in range(k)]) for o, k in sorted(splits.items())])
    near = F.filter(F.flatten(others), lambda x: F.abs(x["ones"] - F.col("ones")) <= radius)
    own = F.struct("ones", "part")
    meets = tiles.select(own.alias("own"), F.explode(near).alias("other"), "fps")
    pairs = meets.select(F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") <= F.col("other")).alias("is_p"), "fps")
    schema = "u long, v long"

    def compare(key, rows: pa.Table) -> pa.Table:
        sides = {bool(r["is_p"]): np.array(r["fps"], dtype=np.int64).view(np.uint64) for r in rows.select(["is_p", "fps"]).to_pylist()}
        if len(sides) < (1 if key[0] == key[1] else 2):  # a tile that got no rows
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        u, v = tile_links(sides[True], sides.get(False), radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return pairs.groupBy("p", "q").applyInArrow(lambda key, rows: compare(key, rows), schema)


def roots(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, root): the smallest fingerprint of each one's component."""
    distinct = stored(fps.select("fp").distinct(), "fps")
    found = components(links(distinct, radius, tile))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
) -> DataFrame:
    """Per row: id, fingerprint (16 lowercase hex digits), component_id (smallest id reachable over links).

    Null and wordless texts have fingerprint zero and link like any other. Null ids
    count only where a component has no other id. Extra columns are ignored; an empty table gives no rows.
    """
    fps = stored(fingerprints(docs, [F.col(id_col).alias("id")], text_col, shingle), "simhash")
    first = fps.groupBy("fp").agg(F.min("id").alias("id"))
    known = stored(first.join(roots(fps, radius, tile), "fp"), "roots")
    named = known.groupBy("root").agg(F.min("id").alias("component_id"))
    named = known.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(named, "fp", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays
    (null ids last; among rows of that id, one text, one row)."""
    ident = F.xxhash64(F.col(id_col), F.col(text_col))
    fps = stored(fingerprints(docs, [F.col(id_col).alias("id"), ident.alias("ident")], text_col, shingle), "simhash")
    best = fps.groupBy("fp", F.col("id").isNull().alias("no_id"), "id", "ident").agg(F.count("*").alias("n"))
    best = best.groupBy("fp").agg(F.min(F.struct("no_id", "id", "ident", "n")).alias("best"))
    winners = best.join(roots(fps, radius, tile), "fp").groupBy("root").agg(F.min("best").alias("best"))
    winners = stored(winners.select("best.*"), "winners")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), ident.alias("ident")).alias("d")
    w = winners.alias("w")
    kept = rows.join(w, (F.col("d.ident") == F.col("w.ident")) & F.col("d.id").eqNullSafe(F.col("w.id")), "left_semi")
    if not winners.where("n > 1").isEmpty():  # the same document more than once
        kept = kept.dropDuplicates(["id", "ident"])
    return kept.select("row.*")
