"""BPE codec, conversation repair and spelling variants against the library or brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from utxolake.llm import bpe_codec, conversation_repair, spelling_variants

rng = random.Random(11)

# -- BPE encoding and decoding

VOCABULARIES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
LETTERS = "".join(rng.choice("abé '1.\nİ日") for _ in range(400))
TEXTS = [
    None, "", " \n", "It's  WE'LL '' 1999", "see <|endoftext|> Here<|startoftext|>", "<|ENDOFTEXT|>", "日本語 тест 😀 İstanbul ﬁ İ x", "a" * 5000,
    "ab" * 3000 + "é", LETTERS, "ÀÉ ß µ \xa0 \x00 \x85", "café   ​", "word " * 3000,
]
TEXTS += ["".join(rng.choice("aaath in") for _ in range(rng.randint(1, 200))) for _ in range(100)]
TEXTS += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(60)) for _ in range(100)]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_codec_equals_the_library(make_docs, name, monkeypatch):
    path, library = public_tokenizers.path(name), Tokenizer.from_file(public_tokenizers.path(name))
    rows = [*enumerate(TEXTS), (3, "again"), (3, "again"), (None, "no id")]
    got = bpe_codec.encode(make_docs(rows, extra=True), path)
    got = got.select("doc_id", "ids", bpe_codec.decode(F.col("ids"), path).alias("text")).collect()
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in got) == Counter((i, tuple(ids), library.decode(ids, skip_special_tokens=False)) for i, ids in want)
    assert bpe_codec.encode(make_docs([]), path).count() == 0


@pytest.mark.parametrize("name", VOCABULARIES)
def test_decoding_of_any_ids(name):
    path, library, table = public_tokenizers.path(name), Tokenizer.from_file(public_tokenizers.path(name)), bpe_codec.OffsetTable(public_tokenizers.path(name))
    gen = np.random.default_rng(3)
    lists = [gen.integers(0, 60_000, n).tolist() for n in (0, 1, 5, 300)] + [[70_000], []]
    got = table.decode(pa.array([i for ids in lists for i in ids], pa.int32()), np.cumsum([len(ids) for ids in lists]))
    assert got == [library.decode(ids, skip_special_tokens=False) for ids in lists]


def test_worker_memory_is_dropped_when_full(monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED_PAIRS", 5)
    monkeypatch.setattr(bpe_codec, "REMEMBERED_WORDS", 3)
    path = public_tokenizers.path(VOCABULARIES[0])
    enc, library = bpe_codec.BacktrackingEncoder(path), Tokenizer.from_file(path)
    for text in TEXTS[1:]:
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(enc.pairs) <= 5 and len(enc.latin) <= 3 and len(enc.other) <= 3


def test_small_vocabularies_by_greedy_merging():
    """Random merge lists: every word's ids are those of merging the least rank first, leftmost first."""
    for seed in range(60):
        gen = random.Random(seed)
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(merges) < gen.randint(1, 12):
            a, b = gen.choice(list(vocab)), gen.choice(list(vocab))
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append([a, b])
        enc = bpe_codec.BacktrackingEncoder.__new__(bpe_codec.BacktrackingEncoder)
        enc.prepare({"type": "BPE", "vocab": vocab, "merges": merges})
        rank = {tuple(m): r for r, m in enumerate(merges)}
        for n in range(1, 8):
            for word in map("".join, product("abc", repeat=n)) if n < 6 else ["".join(gen.choice("abc") for _ in range(12)) for _ in range(50)]:
                parts = list(word)
                while len(parts) > 1 and (best := min((rank.get(p, 99), i) for i, p in enumerate(zip(parts, parts[1:]))))[0] < 99:
                    i = best[1]
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                assert enc.word_ids(word) == [vocab[p] for p in parts]


# -- conversation structure

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_repair(rows):
    """Least (cost, audit) by trying every edit of every message."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = re.sub("[\x20\x09-\x0d]+$", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))

    def keep(state, initial):
        return initial if (initial == "s" and state == "") or (initial == "u" and state != "u") or (initial == "a" and state == "u") else None

    # by the last role initial: every (cost, audit, messages) of least cost, since one audit may begin another
    table = {"": {(0, "", ())}}

    def grow(table):
        for _ in range(3):
            for state, entries in list(table.items()):
                new = "a" if state == "u" else "u"
                add(table, new, {(c + 3, a + "I", (*o, ({"u": "user", "a": "assistant"}[new], ""))) for c, a, o in entries})
        return table

    def add(table, state, entries):
        both = table.get(state, set()) | entries
        least = min(c for c, _, _ in both)
        table[state] = {e for e in both if e[0] == least}

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        grow(table)
        after = {}
        for state, entries in table.items():
            add(after, state, {(c + 4, a + "D", o) for c, a, o in entries})
            if fault in ("blank", "duplicate"):
                continue
            cut = 3 if fault == "truncated" else 0
            if (kept := keep(state, role[:1])) is not None and kept != "":
                add(after, kept, {(c + cut, a + "K", (*o, (role, text))) for c, a, o in entries})
            new = "a" if state == "u" else "u"
            add(after, new, {(c + cut + 3, a + "R", (*o, ({"u": "user", "a": "assistant"}[new], text))) for c, a, o in entries})
        table = after
    grow(table)
    cost, audit, out = min(e for s in ("", "a") for e in table.get(s, ()))
    turns = [t for _, t, _, _ in rows if t is not None]
    initials = [r[2][:1] for r in rows]
    count = Counter(faults)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def some_conversations(n):
    gen, rows = random.Random(2), []
    for conv in range(n):
        for turn in range(gen.choice([1, 2, 3, 5, 8, 9])):
            role = gen.choice(["user", "assistant"][turn % 2 : turn % 2 + 1] * 3 + ["system", "assistant", "", None, "tool", "User"])
            text = gen.choice(["Yes.", "No!", "cut", " \t", "", None, "a\nb?", "Well. \n", f"text {turn}.", "é "])
            rows.append((conv, gen.choice([turn, turn, turn, turn + 2, None]), role, text))
    return [*rows, (None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), *rows[:30]]


def long_conversation(n):
    gen = random.Random(4)
    return [(-5, k // 2 if k % 7 else None, gen.choice(["user", "assistant", "system"]), gen.choice(["ok", "ok.", "", f"{gen.randint(0, n)}."])) for k in range(n)]


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("block_rows", [16_384, 3])
def test_conversations_repaired(llm, block_rows):
    rows = some_conversations(150) + long_conversation(60)
    table = llm.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "'x' as conv", "'y' as copies", "'z' as audit").repartition(5)
    done = conversation_repair.repair(conversation_repair.damage(table), copies_col="copies", block_rows=block_rows, with_messages=True)
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in done.conversations.collect()}
    by_conv = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        by_conv[r[0]].append(r)
    assert got == {conv: brute_repair(own) for conv, own in by_conv.items()}
    text = defaultdict(list)
    for r in sorted(done.messages.collect(), key=lambda r: (r["part"] or 0, r["block"] or 0)):
        text[r["conv_id"]] += [f"{m['role']}:{m['text']}" for m in r["messages"]]
    assert {c: hashlib.sha256("\n".join(lines).encode()).hexdigest() for c, lines in text.items()} == {c: g[-1] for c, g in got.items()}


def test_conversations_without_messages(llm):
    empty = llm.createDataFrame([], CONVERSATIONS)
    assert conversation_repair.repair(empty).conversations.count() == 0
    gone = llm.createDataFrame([(1, 0, "user", "Hi.", 0), (1, 1, "user", "Hi.", 0), (2, 5, None, None, 1)], CONVERSATIONS + ", copies int")
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in conversation_repair.repair(gone, copies_col="copies").conversations.collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "", none), 2: (0, 1, 0, 0, 0, 4, "D", none)}


def test_long_conversation_in_blocks(llm):
    """A conversation longer than several blocks has the result it has in one."""
    rows = llm.createDataFrame(long_conversation(3_000), CONVERSATIONS)
    whole, parts = (conversation_repair.repair(rows, block_rows=n).conversations.collect() for n in (10_000, 257))
    assert whole == parts and len(whole) == 1


# -- spelling variants


def brute_words(rows, misspell=True, min_length=5, min_count=3):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if misspell and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(count):
    near = {w: [v for v in count if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in count}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count.get(form[w]))
    return out


def some_words(n):
    gen, count = random.Random(9), {}
    while len(count) < n:
        word = "".join(gen.choice(["an", "en", "éa", "st", "t", "ä", "ch"]) for _ in range(gen.randint(2, 4)))
        for _ in range(gen.randint(1, 4)):
            count[word] = gen.choice([3, 6, 7, 12, 24, 50, 1000])
            k = gen.randrange(len(word) + 1)
            word = gen.choice([word[:k] + word[k + 1 :], word[:k] + gen.choice("aeöz日") + word[k:], word[:k] + gen.choice("aeöz😀") + word[k + 1 :]])
    return count


@pytest.mark.parametrize("block_words, tile_words", [(32_768, 32), (40, 4), (7, 1)])
def test_variants_grouped(llm, block_words, tile_words):
    count = {w: n for w, n in some_words(300).items() if w}
    count |= {"a" * 60: 5, "a" * 61: 50, "a" * 59 + "b": 500, "b" + "a" * 60: 5, "abcde": 3, "bacde": 30, "x": 9, "": 2, "yx": 1}
    rows = [(w, n - 1, "r") for w, n in count.items()] + [(w, 1, "s") for w in count] + [(None, 5, "t"), ("nocount", None, "u")]
    table = llm.createDataFrame(rows, "word string, n long, root string").selectExpr("*", "'q' as best", "'q' as form").repartition(3)
    got = spelling_variants.group_variants(table, block_words=block_words, tile_words=tile_words).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute_variants(count)
    assert len(got) == len(count)


def test_words_counted(make_docs):
    gen = random.Random(3)
    stems = ["Haus", "Häuser", "forêts", "STRASSE", "straße", "running", "xy", "ÉTÉ", "été", "a\u00d7b\u00f7cde"]
    rows = [(i, " ".join(gen.choice(stems) for _ in range(60)) + "x1y_z-İstanbul") for i in range(300)] + [(None, "running running running"), (7, None), (8, ""), (9, "y" * 30_000)] * 2
    for misspell in (True, False):
        got = {r["word"]: r["n"] for r in spelling_variants.word_counts(make_docs(rows, extra=True), misspell=misspell).collect()}
        assert got == brute_words(rows, misspell)
    assert spelling_variants.group_variants(spelling_variants.word_counts(make_docs([]))).count() == 0


def test_forms_followed_to_the_last(llm):
    words = [("abcdef"[: 6 - k % 2] + "z" * (k // 2), 4**k * 3) for k in range(8)]
    chain = {w: n for w, n in words}
    got = spelling_variants.group_variants(llm.createDataFrame(list(chain.items()), "word string, n long")).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute_variants(chain)


def test_registered_queries(llm, tmp_path):
    """op11 to op13 as registered, over small whole tables, against the library and brute force."""
    from utxolake.llm import queries

    docs = [(i, t) for i, t in enumerate(TEXTS[:13])]
    llm.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.queries()["op11_bpe_codec"](llm, str(tmp_path)).collect()}
    assert got == want
    many = [(i, " ".join(random.Random(i).choice(["Kinder", "Rinder", "Kindern", "forests", "forêts", "running"]) for _ in range(40))) for i in range(400)]
    llm.createDataFrame(many, "doc_id long, text string").write.parquet(f"{tmp_path}/words/documents.parquet")
    got = queries.queries()["op13_spelling_variants"](llm, f"{tmp_path}/words").collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute_variants(brute_words(many))
    rows = some_conversations(40)
    llm.createDataFrame(rows, CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    by_conv = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        by_conv[r[0]].append(r)
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in queries.queries()["op12_conversation_repair"](llm, str(tmp_path)).collect()}
    assert got == {conv: brute_repair(own) for conv, own in by_conv.items()}
