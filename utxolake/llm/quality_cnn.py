"""Document quality by a byte-level convolutional network in numpy.

Bytes get a learned embedding. Filters slide over chunks of 16 bytes that overlap by
half and cover the whole text; beside the embedded bytes they see how often the
chunk's bytes equal those 1 to ``LAGS`` places before, so that a filter can answer to
repetition. Each filter's largest response over all chunks, rectified, enters a
logistic output.

The network is fitted on the driver to at most ``TRAIN_DOCS`` labelled documents of
``SEGMENT`` bytes at most, and ``TRAIN_BYTES`` of text in all (in the order of a hash of
the id), and applied to every
document in the tasks that read them. Texts are taken in segments of ``SEGMENT`` bytes, each with the
bytes around it that its chunks look at; a document's responses are the maxima over its segments, which are
those of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import bucket_crc32, text_or_empty

TRAIN_DOCS = 4_000
TRAIN_BYTES = 24 << 20
THRESHOLD = 0.3
HELD_OUT_OF = 5

BLOCK, EMBED, LAGS, FILTERS = 8, 8, 24, 16
WIDTH = EMBED * BLOCK + LAGS
SEGMENT, BATCH = 1 << 18, 1 << 18
MINIBATCH, RATE, SEED = 32, 0.01, 7
#: Passes over the training documents, and minibatches at least.
EPOCHS, STEPS = 12, 1_000


@dataclass
class Model:
    embed: np.ndarray  # (256, EMBED)
    filters: np.ndarray  # (2 * WIDTH, FILTERS): the chunk's first block, then its second
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (FILTERS,)
    base: np.ndarray  # (1,)

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.base]


def lay_out(pieces: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of text in one byte array, each between what comes before it (LAGS bytes; zeros at a text's start) and
    after it (one block, or nothing at a text's end), filled up to whole blocks and one at least. Gives the first block of
    each piece, which blocks hold text, and which begin a chunk: those of the pieces themselves."""
    parts, firsts, blocks, after, at = [], [], [], [], 0
    for before, text, following in pieces:
        n = max(1, -(-len(text) // BLOCK))
        parts += [before, text, bytes(n * BLOCK - len(text)), following]
        firsts.append(at + LAGS // BLOCK)
        blocks.append(n)
        after.append(len(following) // BLOCK)
        at += LAGS // BLOCK + n + after[-1]
    parts.append(bytes(LAGS))  # the block after the last one
    firsts, blocks = np.array(firsts), np.array(blocks)

    def covered(ends: np.ndarray) -> np.ndarray:
        edge = np.zeros(at + LAGS // BLOCK + 1, np.int64)
        edge[firsts] += 1
        np.subtract.at(edge, ends, 1)
        return np.cumsum(edge)[:-1] > 0

    return np.frombuffer(b"".join(parts), np.uint8), firsts, covered(firsts + blocks + np.array(after)), covered(firsts + blocks)


def block_inputs(model: Model, data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """(blocks, WIDTH): embedded bytes, and shares of bytes equal to an earlier one."""
    n = len(data) // BLOCK
    x = np.empty((n, WIDTH), np.float32)
    x[:, : EMBED * BLOCK] = model.embed[data].reshape(n, -1)
    same = np.zeros(len(data), bool)
    for lag in range(1, LAGS + 1):
        same[:lag] = False
        np.equal(data[lag:], data[:-lag], out=same[lag:])
        # eight 0/1 bytes summed by one multiplication
        x[:, EMBED * BLOCK + lag - 1] = (same.view(np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56)
    x[:, EMBED * BLOCK :] *= 1 / BLOCK
    x[~inside, EMBED * BLOCK :] = 0
    return x


def responses(model: Model, pieces: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Filter responses of every chunk (blocks - 1, FILTERS), with inputs, bytes and first blocks."""
    data, firsts, inside, begins = lay_out(pieces)
    x = block_inputs(model, data, inside)
    both = x @ np.concatenate([model.filters[:WIDTH], model.filters[WIDTH:]], axis=1)
    y = both[:-1, :FILTERS] + both[1:, FILTERS:]
    y[~begins[:-1]] = -np.inf
    return y, x, data, firsts


def _pooled(model: Model, pieces: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
    y, _, _, firsts = responses(model, pieces)
    return np.maximum.reduceat(y, firsts, axis=0)


def _probability(model: Model, pooled: np.ndarray) -> np.ndarray:
    z = np.maximum(pooled + model.bias, 0).astype(np.float64) @ model.out + model.base[0]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _segments(text: bytes) -> list[tuple[bytes, bytes, bytes]]:
    """Pieces of SEGMENT bytes with the bytes around them, so that every chunk is what it is in the whole text."""
    size, lead = SEGMENT // BLOCK * BLOCK, bytes(LAGS)
    out = []
    for at in range(0, max(len(text), 1), size):
        following = text[at + size : at + size + BLOCK]
        following += bytes(-len(following) % BLOCK)
        out.append(((lead + text[max(0, at - LAGS) : at])[-LAGS:], text[at : at + size], following))
    return out


def score(model: Model | None, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for whole texts; 0.5 without a model."""
    if model is None:
        return np.full(len(texts), 0.5)
    pooled = np.full((len(texts), FILTERS), -np.inf, np.float32)
    batch, owner, held = [], [], 0

    def flush():
        nonlocal batch, owner, held
        if batch:
            np.maximum.at(pooled, owner, _pooled(model, batch))
        batch, owner, held = [], [], 0

    for i, text in enumerate(texts):
        for segment in _segments(text):
            batch.append(segment)
            owner.append(i)
            held += len(segment[1]) + LAGS
            if held >= BATCH:
                flush()
    flush()
    return np.round(_probability(model, pooled), 6)


def fit(texts: list[bytes], labels: list[int]) -> Model | None:
    """Fit by Adam on the logistic loss; None without labelled texts."""
    if not texts:
        return None
    rng = np.random.default_rng(SEED)
    share = min(max(np.mean(labels), 0.01), 0.99)
    model = Model(
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, 0.15, (2 * WIDTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.2, FILTERS).astype(np.float32), np.array([np.log(share / (1 - share))], np.float32),
    )
    target = np.array(labels, np.float64)
    moments = [(np.zeros_like(a, np.float64), np.zeros_like(a, np.float64)) for a in model.arrays()]
    step, epochs = 0, max(EPOCHS, -(-STEPS * MINIBATCH // len(texts)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), MINIBATCH):
            own = order[lo : lo + MINIBATCH]
            grads = [0.0] * 5
            for part in _by_size(own, texts):
                grads = [g + h for g, h in zip(grads, _gradients(model, [texts[i] for i in part], target[part], len(own)), strict=True)]
            step += 1
            for a, g, (m, v) in zip(model.arrays(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _by_size(rows: np.ndarray, texts: list[bytes]) -> Iterator[np.ndarray]:
    """``rows`` in parts of about ``BATCH`` bytes."""
    part, held = [], 0
    for i in rows:
        part.append(i)
        held += len(texts[i])
        if held >= BATCH:
            yield np.array(part)
            part, held = [], 0
    if part:
        yield np.array(part)


def _gradients(model: Model, texts: list[bytes], target: np.ndarray, of: int) -> list[np.ndarray]:
    """The share that ``texts`` have in the gradients of a minibatch of ``of``."""
    y, x, data, firsts = responses(model, [(bytes(LAGS), text, b"") for text in texts])
    pooled = np.maximum.reduceat(y, firsts, axis=0)
    hidden = np.maximum(pooled + model.bias, 0).astype(np.float64)
    wrong = (_probability(model, pooled) - target) / of
    to_hidden = wrong[:, None] * model.out[None, :] * (hidden > 0)
    g_filters, g_embed = np.zeros((2 * WIDTH, FILTERS)), np.zeros((256, EMBED))
    ends = np.append(firsts[1:], len(y))
    for d, (lo, hi) in enumerate(zip(firsts, ends, strict=True)):
        chunk = lo + np.argmax(y[lo:hi], axis=0)  # one per filter: only it carries a gradient
        inputs = np.concatenate([x[chunk], x[chunk + 1]], axis=1)
        g_filters += (inputs * to_hidden[d][:, None]).T
        back = to_hidden[d][:, None] * model.filters.T
        for half in (0, 1):
            at = (chunk + half)[:, None] * BLOCK + np.arange(BLOCK)
            np.add.at(g_embed, data[at].ravel(), back[:, half * WIDTH : half * WIDTH + EMBED * BLOCK].reshape(-1, EMBED))
    return [g_embed, g_filters + 1e-4 * len(texts) / of * model.filters, to_hidden.sum(axis=0), hidden.T @ wrong + 1e-4 * len(texts) / of * model.out, np.array([wrong.sum()])]


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from the rows of ``labels`` whose crc32(id as text) mod 5 is not 0 and whose label is 0 or 1.

    Ids are chosen from the labels, so that one read of the documents finds their texts.
    """
    ident, label = F.col(id_col), F.col(label_col).cast("int")
    known = labels.where((bucket_crc32(ident, HELD_OUT_OF) != 0) & label.isin(0, 1)).select(ident.alias("id"), label.alias("y"))
    chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_docs)
    rows = docs.select(ident.alias("id"), text_or_empty(F.col(text_col)).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.where(F.octet_length("text") <= SEGMENT).orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(max_docs)  # an id may have several rows
    order = Window.orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("bytes", F.sum(F.octet_length("text")).over(order)).where(F.col("bytes") <= max_bytes).collect()
    return fit([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["y"] for r in rows])


def classify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out (crc32 of the id as text mod 5 is 0; false for a null id), score, predicted.

    A null text is scored as an empty one. Extra columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    scored = docs.select(F.col(id_col), quality_score(docs.sparkSession, model, F.col("text")).alias("score"))
    return scored.select(id_col, F.coalesce(bucket_crc32(F.col(id_col), HELD_OUT_OF) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_score(spark, model: Model | None, text):
    """The score as a column."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score(held.value, [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]))

    return scores(text_or_empty(text))
