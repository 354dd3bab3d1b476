"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Words get vectors of letter counts. One replaced code point changes the squared distance
of two vectors to 2 at most, one inserted or deleted to 1. The vocabulary is cut into blocks of
``BLOCK_WORDS`` words in the order of length and of a few letters' counts; a block is one row,
its words in the order of a k-d tree over the counts, in tiles of ``TILE_WORDS``. Pairs of
blocks, and in them pairs of tiles, take part if their lengths differ by one at most and
their boxes of counts lie no further apart than a squared distance of 2. A tile's product
with the other block's remaining tiles gives the squared distances; pairs at most two apart
are compared letter by letter.

Counting words is plain SQL with partial aggregation; block pairs are tasks of bounded
size, so no word is a hot group. Letters a to z and U+00C0 to U+00FF have a count each;
other code points share ``OTHERS`` counts, which can only add pairs to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.functions.ordinal import global_ordinal
from utxolake.llm.common import stored

WORD = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 5, 3
#: A word's form is at least this many times as frequent.
RATIO = 2
BLOCK_WORDS, TILE_WORDS = 32_768, 32
#: Tiles of the one block that are multiplied at once with the tiles of the other.
ROW_TILES = 4
OTHERS = 38
LETTERS = 26 + 64 + OTHERS
#: Words up to this length are compared as rows of a matrix.
ROW_LENGTH = 48
#: Candidates compared at once.
BATCH_PAIRS = 1 << 18
#: Counts that order the vocabulary before it is cut; the choice only changes how much is skipped.
ORDER_LETTERS = "enirats"


def runs(text: Column) -> Column:
    """The maximal runs of letters of a text, with A to Z in lower case; null: none."""
    found = F.regexp_extract_all(text.cast("string"), F.lit(f"({WORD})"), F.lit(1))
    return F.transform(found, lambda run: F.translate(run, UPPER, LOWER))


def misspelt(ident: Column, run: Column, every: int = 97) -> Column:
    """``run`` without code point h % length, where ``every`` divides h, the crc32 of ``<ident>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", misspell: bool = False, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points with at least ``min_count`` occurrences in all texts."""
    run = docs.select(F.col(id_col).alias("ident"), F.explode(runs(F.col(text_col))).alias("run"))
    if misspell:
        run = run.select(misspelt(F.col("ident"), F.col("run")).alias("run"))
    return run.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# -- letter counts, tiles


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after the other, and where each word ends."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), np.cumsum([len(w) for w in words])


def letter_counts(words: list[str]) -> np.ndarray:
    codes, ends = _codes(words)
    slot = np.where((codes >= 97) & (codes <= 122), codes - 97, np.where((codes >= 0xC0) & (codes <= 0xFF), codes - 0xC0 + 26, 90 + codes % OTHERS))
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    return np.bincount(owner * LETTERS + slot, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)


def tile_order(counts: np.ndarray, tile: int) -> tuple[np.ndarray, list[int]]:
    """An order of the rows in which tiles of at most ``tile`` rows are compact, and the tiles' ends. Rows are halved
    at a value of the column that varies most."""
    order, ends, todo = [], [], [np.arange(len(counts))]
    while todo:
        rows = todo.pop()
        if len(rows) > tile:
            own = counts[rows]
            at = own[:, int(np.argmax(own.var(axis=0)))]
            cut = np.median(at)
            low = at <= cut if (at <= cut).sum() < len(rows) else at < cut
            if 0 < low.sum() < len(rows):
                todo += [rows[~low], rows[low]]
                continue
            low = np.arange(len(rows)) < len(rows) // 2  # equal counts throughout
            todo += [rows[~low], rows[low]]
            continue
        order.append(rows)
        ends.append(len(rows))
    return np.concatenate(order), np.cumsum(ends).tolist()


class Block:
    """Words in tiles, with counts, boxes and padded code points from either end."""

    def __init__(self, words: list[str], n: list[int], ends: list[int]):
        self.words, self.n = words, np.array(n, np.int64)
        counts = letter_counts(words)
        self.lengths = counts.sum(axis=1)
        squares = (counts.astype(np.int64) ** 2).sum(axis=1)
        exact = np.float32 if int(squares.max()) < 1 << 22 else np.float64  # products stay whole numbers in either
        self.counts, self.squares = counts.astype(exact), squares.astype(exact)
        self.starts, self.ends = np.array([0, *ends[:-1]]), np.array(ends)
        self.low, self.high = (f.reduceat(counts, self.starts, axis=0).astype(np.float32) for f in (np.minimum, np.maximum))
        self.short, self.long = (f.reduceat(self.lengths, self.starts) for f in (np.minimum, np.maximum))
        self.by_word = np.empty(len(words), np.int64)
        self.by_word[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.from_left, self.from_right = self._rows()

    def _rows(self) -> tuple[np.ndarray, np.ndarray]:
        codes, ends = _codes(self.words)
        place = np.arange(ROW_LENGTH)
        inside = place < np.minimum(self.lengths, ROW_LENGTH)[:, None]
        first = (ends - self.lengths)[:, None]
        left = np.where(inside, codes[np.where(inside, first + place, 0)], 0)
        right = np.where(inside, codes[np.where(inside, ends[:, None] - 1 - place, 0)], 0)
        small = np.uint32 if codes.max(initial=0) >= 1 << 16 else np.uint16
        return left.astype(small), right.astype(small)


def _one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def one_edit_apart(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs of words differ by one code point inserted, deleted or replaced."""
    by, out = a.lengths[i] - b.lengths[j], np.zeros(len(i), bool)
    long = np.maximum(a.lengths[i], b.lengths[j]) > ROW_LENGTH
    width = min(ROW_LENGTH, int(max(a.lengths.max(), b.lengths.max())))
    left_a, right_a, left_b, right_b = (rows[:, :width] for rows in (a.from_left, a.from_right, b.from_left, b.from_right))
    same = np.flatnonzero((by == 0) & ~long)
    out[same] = (left_a[i[same]] != left_b[j[same]]).sum(axis=1) == 1
    near = np.flatnonzero((np.abs(by) == 1) & ~long)
    ends = _common(left_a[i[near]], left_b[j[near]]) + _common(right_a[i[near]], right_b[j[near]])
    out[near] = ends >= np.minimum(a.lengths[i[near]], b.lengths[j[near]])
    for k in np.flatnonzero(long):
        out[k] = _one_edit(a.words[i[k]], b.words[j[k]])
    return out


def near_pairs(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``a``, in ``b``) of words one edit apart; each pair once if the blocks are the ``same``."""
    used = np.flatnonzero(a.high.any(axis=0) | b.high.any(axis=0))
    mine, theirs = (np.ascontiguousarray(x.counts[:, used]) for x in (a, b))
    low, high = b.low[:, used], b.high[:, used]
    first = np.arange(0, len(a.ends), ROW_TILES)
    low_a, high_a = np.minimum.reduceat(a.low[:, used], first), np.maximum.reduceat(a.high[:, used], first)
    short_a, long_a = np.minimum.reduceat(a.short, first), np.maximum.reduceat(a.long, first)
    found, held, n_held = [], [], 0

    def verify():
        nonlocal held, n_held
        if held:
            i, j = (np.concatenate(x) for x in zip(*held, strict=True))
            good = one_edit_apart(a, b, i, j)
            found.append((i[good], j[good]))
        held, n_held = [], 0

    for t, tile in enumerate(first):
        lo, hi = a.starts[tile], a.ends[min(tile + ROW_TILES, len(a.ends)) - 1]
        apart = np.maximum(np.maximum(low - high_a[t], low_a[t] - high), 0)
        take = (np.einsum("ij,ij->i", apart, apart) <= 2) & (b.short <= long_a[t] + 1) & (b.long >= short_a[t] - 1)
        if same:
            take[:tile] = False
        columns = np.flatnonzero(np.repeat(take, b.ends - b.starts))
        if not len(columns):
            continue
        gram = mine[lo:hi] @ theirs[columns].T
        gram *= -2
        gram += a.squares[lo:hi, None]
        gram += b.squares[None, columns]
        i, j = np.divmod(np.flatnonzero(gram <= 2), len(columns))
        i, j = i + lo, columns[j]
        ok = np.abs(a.lengths[i] - b.lengths[j]) <= 1
        if same:
            ok &= j > i
        held.append((i[ok], j[ok]))
        n_held += int(ok.sum())
        if n_held >= BATCH_PAIRS:
            verify()
    verify()
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)


def best_of(mine: Block, theirs: Block, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word of ``mine`` with near words: its place, how many, and the place of the most frequent (ties: smallest)."""
    order = np.lexsort((theirs.by_word[j], -theirs.n[j], i))
    first = np.flatnonzero(np.diff(i[order], prepend=-1))
    return i[order][first], np.diff(np.append(first, len(i))), j[order][first]


# -- the operator


def _blocks(words: DataFrame, block_words: int, tile_words: int) -> DataFrame:
    length = F.length("word").alias("length")
    letters = [(F.length("word") - F.length(F.replace("word", F.lit(c), F.lit("")))).alias(f"l{k}") for k, c in enumerate(ORDER_LETTERS)]
    ordered = global_ordinal(words.select("word", "n", length, *letters), ["length", *(f"l{k}" for k in range(len(ORDER_LETTERS))), "word"], "place")
    cut = ordered.select(((F.col("place") - 1) / block_words).cast("long").alias("block"), "word", "n")
    schema = T._parse_datatype_string("block bigint, words array<string>, n array<bigint>, ends array<int>, short int, long int, low array<int>, high array<int>")

    def tiles(table: pa.Table) -> pa.Table:
        words = table.column("word").to_pylist()
        counts = letter_counts(words)
        order, ends = tile_order(counts, tile_words)
        lengths = counts.sum(axis=1)
        row = [
            table.column("block")[0].as_py(), [words[k] for k in order], table.column("n").to_numpy()[order], ends,
            int(lengths.min()), int(lengths.max()), counts.min(axis=0), counts.max(axis=0),
        ]
        types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=schema.names)

    return stored(cut.groupBy("block").applyInArrow(tiles, schema), "word-blocks")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(a, b), a <= b, of blocks that can hold near words. Joined by length, on the blocks' boxes alone."""
    box = blocks.select("block", "short", "long", "low", "high")
    a = box.select(F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(F.sequence("short", "long")).alias("length"))
    b = box.select(F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.explode(F.sequence(F.col("short") - 1, F.col("long") + 1)).alias("length"))
    gap = F.aggregate(
        F.zip_with(F.arrays_zip("low_a", "high_a"), F.arrays_zip("low_b", "high_b"), lambda x, y: F.greatest(y.low_b - x.high_a, x.low_a - y.high_b, F.lit(0))),
        F.lit(0), lambda total, d: total + d * d,
    )
    return a.join(b, "length").where(F.col("a") <= F.col("b")).where(gap <= 2).select("a", "b").distinct()


def near_words(words: DataFrame, *, block_words: int = BLOCK_WORDS, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for the rows of ``words`` (word, n; each word once) that have near words."""
    blocks = _blocks(words, block_words, tile_words)
    pairs = stored(_block_pairs(blocks), "block-pairs")
    n_pairs = max(1, pairs.count())
    own = blocks.select("block", "words", "n", "ends")
    both = pairs.join(own.toDF("a", "words_a", "n_a", "ends_a"), "a").join(own.toDF("b", "words_b", "n_b", "ends_b"), "b")
    both = both.repartition(min(n_pairs, 10_000), "a", "b")  # a number of tasks that follows the work, not the bytes
    schema = T._parse_datatype_string("word string, n_near bigint, best_n bigint, best string")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                same = r["a"] == r["b"]
                a = Block(r["words_a"], r["n_a"], r["ends_a"])
                b = a if same else Block(r["words_b"], r["n_b"], r["ends_b"])
                i, j = near_pairs(a, b, same)
                if same:
                    sides = [(a, a, np.concatenate([i, j]), np.concatenate([j, i]))]
                else:
                    sides = [(a, b, i, j), (b, a, j, i)]
                for mine, theirs, i, j in sides:
                    if len(i):
                        at, count, best = best_of(mine, theirs, i, j)
                        columns = [pa.array([mine.words[x] for x in at]), pa.array(count, pa.int64()), pa.array(theirs.n[best]), pa.array([theirs.words[x] for x in best])]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = both.mapInArrow(compare, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("of"), F.col("best").alias("word"))).alias("least")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("least.of")).alias("best_n"), F.col("least.word").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of ``links`` (word, form), which has no circles: forms followed to the last one, twice as far each round."""
    ahead = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = ahead.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        ahead = stored(stepped, "roots")
        if ahead.where("moved").limit(1).count() == 0:
            return ahead.select("word", "root")


def group_variants(words: DataFrame, *, ratio: int = RATIO, block_words: int = BLOCK_WORDS, tile_words: int = TILE_WORDS) -> DataFrame:
    """Per row of ``words`` (word, n): word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (ties: the smallest in code-point order) if that occurs at
    least ``ratio`` (2 or more) times as often, else null; its root follows forms to the last, and is the word itself without
    a form. Rows without a word or with no count are left out, rows of equal words are added up, other columns
    are ignored; the empty string is near every single letter; an empty table gives no rows.
    """
    words = words.where(F.col("word").isNotNull() & F.col("n").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stored(words, "words")
    near = near_words(words, block_words=block_words, tile_words=tile_words)
    formed = F.col("best_n") >= ratio * F.col("n")
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"))
    known = stored(known, "forms")
    rooted = roots(known.where("form IS NOT NULL"))
    return known.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
