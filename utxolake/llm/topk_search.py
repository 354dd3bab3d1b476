"""Exact top-k inner products with a vector-approximation file.

Components become integers floor(``SCALE`` * x). The file holds, per vector, its
cells: every dimension's range is cut into ``CELLS`` equal cells, one byte each, beside
the exact vector. For a query the cells bound the inner product from above and below.
A task scans the cells of its rows, then reads exact vectors by decreasing upper bound
until the next bound lies below the kth score found, so the result is exact.

Queries go in blocks of ``QUERY_BLOCK``, each against all rows. A block starts from the
kth score among ``START_ROWS`` rows (of those, the kth best can only be lower), so that tasks
return few rows that can't be in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import stored

SCALE, TOP, CELLS = 64, 20, 256
QUERY_BLOCK, START_ROWS, CHUNK = 4096, 8192, 2048
LONG = 1 << 63


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v: array<double> of whole numbers); rows null or with null or non-finite components go."""
    v = F.col(vec_col).cast("array<double>")
    fine = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    out = np.zeros((len(column), dims))
    if len(column):
        ends = np.asarray(column.offsets)
        sizes = np.diff(ends)
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(column.values)[ends[0] : ends[-1]]
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as longs: exact by doubles where no sum can leave their whole numbers, else by Python integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries) @ whole(rows).T if queries.size and rows.size else np.zeros((len(queries), len(rows)), object)
    if any(not -LONG <= x < LONG for x in exact.ravel()):
        raise OverflowError("an inner product doesn't fit into a long")
    return exact.astype(np.int64)


def cells_of(rows: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((rows - low) / width), 0, CELLS - 1).astype(np.uint8)


class Search:
    """The best rows of one task for a block of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, low: np.ndarray, width: np.ndarray, start: np.ndarray):
        self.ids, self.queries, self.k, self.low, self.width = ids, queries, k, low, width
        self.order = np.argsort(ids, kind="stable")
        self.least = start.copy()  # no row below it can be in the result
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        # half a cell beside its middle, in every dimension; and what rounding may add
        self.slack = np.abs(queries) @ (width / 2)
        self.slack += 1e-9 * (np.abs(queries) @ (np.abs(low) + CELLS * width)) + 1e-6
        self.read = 0

    def add(self, ids: np.ndarray, cells: np.ndarray, exact: np.ndarray) -> None:
        middle = self.low + (cells + 0.5) * self.width
        bound = self.queries @ middle.T + self.slack[:, None]
        # rows with a query's id are no candidates for it, however many there are
        place = np.minimum(np.searchsorted(self.ids, ids, sorter=self.order), len(self.ids) - 1)
        own = np.flatnonzero(self.ids[self.order[place]] == ids)
        bound[self.order[place[own]], own] = -np.inf
        # a row's bound from below lies two slacks lower: the kth of these is a floor for the kth score
        if len(ids) >= self.k:
            kth = np.partition(bound, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            self.least = np.maximum(self.least, np.floor(kth - 2 * self.slack))
        for q in np.flatnonzero(bound.max(axis=1) >= self.least).tolist():
            at = np.flatnonzero(bound[q] >= self.least[q])
            at = at[np.argsort(-bound[q, at], kind="stable")]
            for lo in range(0, len(at), 4 * self.k):  # exact vectors by decreasing bound, until the kth score is certain
                some = at[lo : lo + 4 * self.k]
                some = some[bound[q, some] >= self.least[q]]
                if not len(some):
                    break
                self._take(q, ids[some], products(self.queries[q : q + 1], exact[some])[0])
                self.read += len(some)

    def _take(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != self.ids[q]
        own_ids, own_scores = self.best[q]
        ids, scores = np.concatenate([own_ids, ids[other]]), np.concatenate([own_scores, scores[other]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[q] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], int(scores[order[-1]]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = [len(ids) for ids, _ in self.best]
        query = np.repeat(np.arange(len(self.ids)), n)
        ids = np.concatenate([ids for ids, _ in self.best] or [np.zeros(0, np.int64)])
        scores = np.concatenate([s for _, s in self.best] or [np.zeros(0, np.int64)])
        return query, ids, scores


def _range(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest component of every dimension, over all rows."""
    schema = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.full(dims, np.inf), np.full(dims, -np.inf)
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0), dims)
                lo, hi = np.minimum(lo, m.min(axis=0)), np.maximum(hi, m.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(lo), pa.array(hi)], names=schema.names)

    found = {r["d"]: r for r in vectors.select("v").mapInArrow(task, schema).groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    return np.array([found[d]["lo"] for d in range(dims)]), np.array([found[d]["hi"] for d in range(dims)])


def approximation_file(vectors: DataFrame, dims: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The stored (id, cells, v), and each dimension's lowest value and cell width."""
    low, high = _range(vectors, dims)
    width = np.maximum((high - low + 1) / CELLS, 1e-9)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("cells", T.BinaryType()), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = cells_of(_matrix(b.column(1), dims), low, width)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in cells], pa.binary()), b.column(1)], names=schema.names)

    return stored(vectors.mapInArrow(task, schema), "va-file"), low, width


def top_k(
    table: DataFrame, is_query, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = TOP, scale: int = SCALE,
    query_block: int = QUERY_BLOCK, start_rows: int = START_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), id, score of each query's k best other rows.

    ``is_query`` is a condition on ``id``. Ties go to the smaller id. Rows that share a query's id
    are its own and no candidates for it; repeated ids otherwise are rows of their own. Of a repeated query id
    the smallest vector, by its first component that differs, is the query. Null ids,
    null vectors and vectors with null or non-finite components take no part; shorter vectors count
    as filled up with zeros. Extra columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    vectors = stored(integer_vectors(table, id_col, vec_col, scale), "vectors")
    dims = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    out = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], out)
    if not vectors.isEmpty():
        file, low, width = approximation_file(vectors, dims)
        some = _vectors(file.limit(start_rows), dims)
        queries = file.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
        n_blocks = -(-queries.count() // query_block)
        for b in range(n_blocks):
            ids, own = _vectors(queries.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b) if n_blocks > 1 else queries, dims)
            if not len(ids):
                continue
            first = Search(ids, own, k, low, width, np.full(len(ids), -np.inf))
            for lo in range(0, len(some[0]), CHUNK):
                at = slice(lo, lo + CHUNK)
                first.add(some[0][at], cells_of(some[1][at], low, width), some[1][at])
            block = spark.sparkContext.broadcast((ids, own, first.least))

            def task(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
                ids, own, start = block.value
                search = Search(ids, own, k, low, width, start)
                for b in batches:
                    for lo in range(0, b.num_rows, CHUNK):
                        part = b.slice(lo, CHUNK)
                        cells = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, dims)
                        search.add(np.asarray(part.column(0)), cells, _matrix(part.column(2), dims))
                query, rows, scores = search.rows()
                yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(rows), pa.array(scores)], names=out.names)

            near = file.mapInArrow(task, out)
            rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
            near = near.withColumn("rank", rank).where(F.col("rank") <= k)
            found = stored(near.drop("rank"), "near") if found.isEmpty() else stored(found.unionByName(near.drop("rank")), "near")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.select("query_id", rank.cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _vectors(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded block of rows, by id."""
    got = rows.select("id", "v").orderBy("id").collect()
    out = np.zeros((len(got), dims))
    for i, r in enumerate(got):
        out[i, : len(r["v"])] = r["v"]
    return np.array([r["id"] for r in got], dtype=np.int64), out
