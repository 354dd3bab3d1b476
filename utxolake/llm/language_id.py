"""Language spans: script ranges, per-word n-gram scores, Viterbi with a switching penalty.

Words are runs between blanks; where a text leaves the Latin ranges, runs are
also cut where the script changes. A word's script leaves as candidates the
languages whose training text holds that script (all, if none does). Each
candidate scores the word by its character trigrams. Viterbi then labels the words
so that the summed scores less ``PENALTY`` per change of language is largest, and equal
neighbours form spans.

The model is learned from at most about ``TRAIN_DOCS`` documents per language, drawn by
a hash of the id. The search runs over blocks of words: a block's best transitions
between all pairs of languages are found for all blocks of a batch at once, then
chained per document, so no loop runs over single words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utxolake.llm.common import bucket_crc32, text_or_empty

TRAIN_DOCS = 1_000
TRAIN_BYTES = 4 << 20
#: A script counts as a language's if it holds this share of its training letters.
SCRIPT_SHARE = 0.01
PENALTY = 12.0
SMOOTH = 0.5
UNFIT = -60.0
HELD_OUT_OF, HELD_OUT = 4, 2
BLOCK, BATCH_WORDS, REMEMBERED = 32, 200_000, 400_000

# First and last code points of the script ranges told apart.
SCRIPTS = (
    ("latin", 0x0000, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
_RUNS = re.compile("|".join([f"[{chr(lo)}-{chr(hi)}]+" for _, lo, hi in SCRIPTS[1:]] + ["[^\\sͰ-￿]+", "[^\\s\x00-ͯ]"]))
_BEYOND = re.compile("[^\x00-ɏ]")


def script(char: str) -> str:
    code = ord(char)
    return next((name for name, lo, hi in SCRIPTS if lo <= code <= hi), "other")


def split(text: str) -> list[str]:
    if not _BEYOND.search(text):
        return text.split()
    return [run for word in unicodedata.normalize("NFC", text).split() for run in _RUNS.findall(word)]


def _letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def _grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # (languages,)
    gram_no: dict[str, int]
    gram_score: np.ndarray  # (1 + grams, languages); row 0: unseen
    scripts: dict[str, np.ndarray]  # script -> candidate flags


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """Learn from (lang, text)."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    words = [Counter() for _ in langs]
    at = {lang: i for i, lang in enumerate(langs)}
    for lang, text in rows:
        words[at[lang]].update(split(text))
    gram_no: dict[str, int] = {}
    counts, scripts = [], []
    for own in words:
        grams, seen = Counter(), Counter()
        for word, n in own.items():
            if word := _letters(word):
                seen[script(word[0])] += n * len(word)
                for g in _grams(word):
                    grams[gram_no.setdefault(g, len(gram_no) + 1)] += n
        counts.append(grams)
        scripts.append({s for s, n in seen.items() if n >= SCRIPT_SHARE * sum(seen.values())})
    table = np.full((len(gram_no) + 1, len(langs)), SMOOTH)
    for i, grams in enumerate(counts):
        for g, n in grams.items():
            table[g, i] += n
    score = np.log(table / table.sum(axis=0))
    score -= score.max(axis=1, keepdims=True)
    every = np.ones(len(langs), bool)
    flags = {name: np.array([name in s for s in scripts]) for name in {s[0] for s in SCRIPTS} | {"other"}}
    docs = Counter(lang for lang, _ in rows)
    return Model(langs, np.log(np.array([docs[x] for x in langs]) / len(rows)), gram_no, score.astype(np.float32), {k: v if v.any() else every for k, v in flags.items()})


class WordScores:
    """Scores and letter counts of words, remembered while the worker lives."""

    def __init__(self, model: Model):
        self.model, self.no = model, {}
        self.scores = np.zeros((1 << 16, len(model.langs)), np.float32)
        self.letters = np.zeros(1 << 16, np.int64)

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        no = self.no
        if len(no) > REMEMBERED:
            no.clear()
        new = [w for w in set(words) if w not in no]
        if new:
            self._learn(new)
        rows = np.fromiter(map(no.__getitem__, words), np.int64, len(words))
        return self.scores[rows], self.letters[rows]

    def _learn(self, new: list[str]) -> None:
        first, gram_no = len(self.no), self.model.gram_no.get
        need = first + len(new)
        while need > len(self.letters):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        grams, ends, n_letters, unfit = [], [], [], []
        for i, word in enumerate(new):
            self.no[word] = first + i
            clean = _letters(word)
            n_letters.append(len(clean))
            if clean:
                padded = f" {clean} "
                grams += [gram_no(padded[k : k + 3], 0) for k in range(len(clean))]
                if not clean.isascii():
                    flags = self.model.scripts[script(clean[0])]
                    if not flags.all():
                        unfit.append((first + i, flags))
            ends.append(len(grams))
        total = np.zeros((len(grams) + 1, len(self.model.langs)))
        np.cumsum(self.model.gram_score[grams], axis=0, dtype=np.float64, out=total[1:])
        ends = np.array(ends)
        self.scores[first:need] = total[ends] - total[np.concatenate([[0], ends[:-1]])]
        latin = self.model.scripts["latin"]
        if not latin.all():
            ascii_rows = [first + i for i, w in enumerate(new) if w.isascii()]
            self.scores[np.ix_(ascii_rows, np.flatnonzero(~latin))] += UNFIT
        for row, flags in unfit:
            self.scores[row, ~flags] += UNFIT
        self.letters[first:need] = n_letters


def _step(best: np.ndarray, scores: np.ndarray, penalty: float) -> np.ndarray:
    return np.maximum(best, best.max(axis=-1, keepdims=True) - penalty) + scores


def viterbi(scores: np.ndarray, lengths: np.ndarray, prior: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word. ``scores`` (words, languages), documents one after another."""
    n_lang = scores.shape[1]
    blocks = -(-lengths // BLOCK)
    n = int(blocks.sum())
    if not n:
        return np.zeros(0, np.int64)
    first = np.cumsum(blocks) - blocks
    word = np.cumsum(lengths) - lengths
    slot = np.arange(lengths.sum()) + np.repeat(first * BLOCK - word, lengths)
    x = np.zeros((n * BLOCK, n_lang), np.float64)
    x[slot] = scores
    x = x.reshape(n, BLOCK, n_lang)
    through = np.where(np.eye(n_lang, dtype=bool), 0.0, -penalty)[None] + x[:, 0][:, None]
    for t in range(1, BLOCK):
        through = _step(through, x[:, t][:, None], penalty)
    # chain the blocks of each document; before its first word every language costs its prior
    enter = np.empty((n, n_lang))
    enter[first[blocks > 0]] = prior
    most = int(blocks.max())
    for k in range(most - 1):
        at = first[blocks > k + 1] + k
        enter[at + 1] = (enter[at][:, :, None] + through[at]).max(axis=1)
    steps = np.empty((BLOCK + 1, n, n_lang))
    steps[0] = enter
    for t in range(BLOCK):
        steps[t + 1] = _step(steps[t], x[:, t], penalty)
    top = steps.argmax(axis=2)
    stay = steps >= steps.max(axis=2, keepdims=True) - penalty  # else the path came from the top one
    rows = np.arange(n)
    came = np.broadcast_to(np.arange(n_lang), (n, n_lang)).copy()
    for t in range(BLOCK - 1, -1, -1):
        came = np.where(np.take_along_axis(stay[t], came, axis=1), came, top[t][:, None])
    leave = np.zeros(n, np.int64)
    last = first + blocks - 1
    leave[last[blocks > 0]] = top[BLOCK][last[blocks > 0]]
    for k in range(most - 1):
        at = last[blocks > k + 1] - k
        leave[at - 1] = came[at, leave[at]]
    label = np.empty((n, BLOCK), np.int64)
    state = leave
    for t in range(BLOCK - 1, -1, -1):
        label[:, t] = state
        state = np.where(stay[t][rows, state], state, top[t])
    return label.reshape(-1)[slot]


def label_texts(known: WordScores, texts: list[str], penalty: float = PENALTY) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(words, labels, letters) of each text."""
    held, sizes = [], []

    def flush():
        scores, letters = known.look_up([w for words in held for w in words])
        labels = viterbi(scores, np.array(sizes), known.model.prior, penalty)
        at = 0
        for words, n in zip(held, sizes, strict=True):
            yield words, labels[at : at + n], letters[at : at + n]
            at += n

    for text in texts:
        held.append(split(text))
        sizes.append(len(held[-1]))
        if sum(sizes) >= BATCH_WORDS:
            yield from flush()
            held, sizes = [], []
    if held:
        yield from flush()


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from rows with text and lang whose crc32(id as text) mod 4 is not 2.

    About ``per_lang`` rows of each language, by a hash of id and text, and of these at most
    ``max_bytes`` each: whole texts in that order while they fit.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((bucket_crc32(F.col("id"), HELD_OUT_OF) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    scale = 1_000_000
    limits = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(scale, -(-scale * per_lang // n)))])
    drawn = F.xxhash64("id", "text")
    rows = rows.where(F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(scale)) < F.element_at(limits, F.col("lang")))
    sample, used = [], Counter()
    for r in rows.where(F.octet_length("text") <= max_bytes).select("lang", "text", drawn.alias("h")).orderBy("h").limit(2 * per_lang * len(counts)).toLocalIterator():
        if used[r["lang"]] + len(r["text"]) <= max_bytes:
            used[r["lang"]] += len(r["text"])
            sample.append((r["lang"], r["text"]))
    return fit(sample)


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY, with_spans: bool = True) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, and spans (first word, one past the last, lang).

    lang_pred is the language of most letters (the first in order among equals), score its
    share of the letters; ``und`` and 0 if the text is null or has no letter, or nothing was
    learned. held_out is false for a null id. Extra columns are ignored; an empty table gives no rows.
    """
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("lang", T.StringType())])
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept: dict = {}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        known = kept.setdefault("known", WordScores(model)) if model else None
        arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = []
            for words, labels, letters in label_texts(known, texts, penalty) if known else (([], None, np.zeros(0)) for _ in texts):
                total = int(letters.sum())
                if not total:
                    out.append(("und", 0.0, []))
                    continue
                share = np.bincount(labels, letters, len(model.langs))
                pick = int(share.argmax())
                spans = []
                if with_spans:
                    edges = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]]).tolist()
                    spans = [{"start": a, "stop": b, "lang": model.langs[labels[a]]} for a, b in zip(edges, edges[1:], strict=False)]
                out.append((model.langs[pick], float(share[pick]) / total, spans))
            preds, shares, spans = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, arrow_span)], names=schema.names)

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text")).mapInArrow(task, schema)
    held_out = F.coalesce(bucket_crc32(F.col("id"), HELD_OUT_OF) == HELD_OUT, F.lit(False))
    return rows.select(F.col("id").alias(id_col), held_out.alias("held_out"), "lang_pred", "score", "spans")
