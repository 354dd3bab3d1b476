"""Learned operators, search and the pipeline: held-out accuracy, brute force, odd inputs."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from utxolake.llm import language_id, packing, queries, quality_cnn, simhash, topk_search
from utxolake.llm.common import table

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert {*names, "pipeline"} <= set(__spark_entry__.queries())


# -- language


def best_path(scores, prior, penalty):
    v = np.maximum(prior, prior.max() - penalty) + scores[0]
    for s in scores[1:]:
        v = np.maximum(v, v.max() - penalty) + s
    return v.max()


def test_viterbi_finds_the_best_path():
    gen = np.random.default_rng(0)
    for _ in range(40):
        n_lang, lengths = gen.integers(1, 5), gen.integers(0, 100, 6)
        scores, prior, at = gen.normal(0, 6, (lengths.sum(), n_lang)), gen.normal(0, 1, n_lang), 0
        labels = language_id.viterbi(scores, lengths, prior, 5.0)
        for n in lengths:
            x, y = scores[at : at + n], labels[at : at + n]
            at += n
            if n:
                own = max(prior[y[0]], prior.max() - 5) + x[np.arange(n), y].sum() - 5 * (np.diff(y) != 0).sum()
                assert abs(own - best_path(x, prior, 5.0)) < 1e-9


def test_languages_of_held_out_documents(llm):
    docs = table(llm, SF, "documents")
    got = {r["doc_id"]: r for r in queries.queries()["op2_language_id"](llm, SF).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(got) == len(truth) and {i for i in got if got[i]["held_out"]} == set(held)
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_spans_and_odd_texts(make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house is here and there", "en"), ("das haus ist hier und dort", "de"), ("дом стоит здесь и там", "ru")] * 30)]
    model = language_id.train(make_docs(rows))
    assert model.langs == ["de", "en", "ru"]
    odd = [(1, None), (2, ""), (3, "12 !?"), (4, "the house is here and there " * 5 + "das haus ist hier und dort " * 5), (5, "дом здесь"), (6, "the house"), (None, "das haus"), (6, "the house"), (7, "ひらがな"), (8, "x" * 100_000)]
    got = language_id.identify(make_docs(odd, extra=True), model)
    by = {(r["doc_id"], r["lang_pred"]): r for r in got.collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "ru"), (6, "en"), (None, "de")} <= set(by)
    spans = next(r["spans"] for k, r in by.items() if k[0] == 4)
    assert [(s["start"], s["stop"], s["lang"]) for s in spans] == [(0, 30, "en"), (30, 60, "de")]
    assert not by[(None, "de")]["held_out"] and {k[1] for k in by if k[0] in (7, 8)} <= set(model.langs)
    assert language_id.train(make_docs([])) is None
    assert [r["lang_pred"] for r in language_id.identify(make_docs([(1, "a word")]), None).collect()] == ["und"]
    assert language_id.identify(make_docs([]), model).count() == 0


# -- quality


def test_quality_of_held_out_documents(llm):
    got = {r["doc_id"]: r for r in queries.queries()["op10_quality"](llm, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(llm, SF, "labels").collect()}
    held = [i for i in labels if i in got and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held) and all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in got.values())
    score, y = np.array([got[i]["score"] for i in held]), np.array([labels[i] for i in held])
    pairs = score[y == 1][:, None] - score[y == 0][None, :]
    assert (pairs > 0).mean() + 0.5 * (pairs == 0).mean() > 0.95


@pytest.mark.parametrize("size", [256, 4_000, 1 << 18])
def test_quality_score_does_not_depend_on_segments(size, monkeypatch):
    """Texts of about one segment, and of several, against one segment for all."""
    gen = np.random.default_rng(5)
    model = quality_cnn.fit([b"fine words here", b"*** $$$ %%%"] * 20, [1, 0] * 20)
    words = [b"fine ", b"words ", b"here. ", b"*** ", b"aaaaaaaaaaaaaaaaaaaaaaaa", b"\x00\x00", b"xyxyxyxyxyxyxyxyxyxyxyxyxyxyxyxy"]
    long = b"".join(words[k] for k in gen.integers(0, len(words), 300_000))[: 1 << 20]
    texts = [long[k : k + size + d] for k in (0, 77) for d in (-9, -1, 0, 1, 7, 8, 9, 25)] + [long, long[:50_000], b""]
    monkeypatch.setattr(quality_cnn, "SEGMENT", 1 << 21)
    whole = [quality_cnn._pooled(model, [(bytes(quality_cnn.LAGS), t, b"")]) for t in texts]
    want = quality_cnn.score(model, texts)
    monkeypatch.setattr(quality_cnn, "SEGMENT", size)
    assert np.allclose(quality_cnn.score(model, texts), want, atol=1e-5)
    for text, pooled in zip(texts, whole, strict=True):
        parts = np.maximum.reduce([quality_cnn._pooled(model, [s]) for s in quality_cnn._segments(text)])
        assert np.allclose(parts, pooled, atol=1e-4)


def test_quality_scores_do_not_depend_on_company(monkeypatch):
    gen = np.random.default_rng(4)
    texts = [bytes(gen.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 7, 8, 9, 100, 5000, 300_000)]
    model = quality_cnn.fit([b"fine words here", b"*** $$$ %%%"] * 20, [1, 0] * 20)
    alone = [quality_cnn.score(model, [t])[0] for t in texts]
    assert np.allclose(quality_cnn.score(model, texts), alone, atol=1e-5)
    data, firsts, inside, _ = quality_cnn.lay_out([(bytes(quality_cnn.LAGS), t, b"") for t in texts])
    assert inside.sum() == sum(max(1, -(-len(t) // 8)) for t in texts)
    good, bad = quality_cnn.score(model, [b"fine words here", b"*** $$$ %%%"])
    assert good > 0.7 > 0.3 > bad


def test_quality_gradients():
    gen = np.random.default_rng(6)
    texts, target = [bytes(gen.integers(97, 123, n, dtype=np.uint8)) for n in (40, 90)], np.array([1.0, 0.0])
    model = quality_cnn.fit(texts, [1, 0])
    model.filters += gen.normal(0, 0.05, model.filters.shape).astype(np.float32)

    def loss():
        p = quality_cnn._probability(model, quality_cnn._pooled(model, [(bytes(quality_cnn.LAGS), t, b"") for t in texts]))
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    grads = quality_cnn._gradients(model, texts, target, 2)
    for array, grad in list(zip(model.arrays(), grads, strict=True))[2:]:
        for k in range(len(array)):
            array[k] += 1e-3
            up = loss()
            array[k] -= 2e-3
            down = loss()
            array[k] += 1e-3
            assert abs((up - down) / 2e-3 - grad[k]) < 1e-2


def test_quality_of_odd_inputs(llm, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "fine words"), (None, "x"), (3, "fine words")], extra=True)
    no_labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_cnn.train(docs, no_labels) is None
    got = quality_cnn.classify(docs, None).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    labels = llm.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_cnn.train(docs, labels)
    assert len(quality_cnn.classify(docs, model).collect()) == 5
    assert quality_cnn.classify(make_docs([]), model).count() == 0


# -- search


def brute_top(rows, is_query, k=20):
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in whole:
        if is_query(i):
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in whole if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return Counter(out)


@pytest.mark.parametrize("block, start, k", [(4096, 8192, 20), (2, 5, 3)])
def test_top_k(llm, block, start, k):
    gen = np.random.default_rng(8)
    rows = [(i, gen.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200, None), (220, []), (240, [None] * 8), (260, [float("nan")] * 8), (280, [float("inf")] * 8), (300, [0.0] * 8), (320, [1.5, -2.0]), (None, [1.0] * 8)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]
    data = llm.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as id", "'y' as score", "1 as rank").repartition(3)
    got = topk_search.top_k(data, lambda i: i % 20 == 0, k=k, query_block=block, start_rows=start)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 20 == 0, k)
    assert topk_search.top_k(data.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("start", [8192, 5])
def test_top_k_of_a_repeated_query_id(llm, start):
    gen = np.random.default_rng(9)
    hot = gen.normal(0, 0.2, 8)
    rows = [(i, gen.normal(0, 0.2, 8).tolist()) for i in range(1, 300)]
    own = [(0, (hot * f).tolist()) for f in [9.0] * 48 + [7.0, 8.0]]
    data = llm.createDataFrame(own + rows, "vec_id long, embedding array<double>").coalesce(1)
    got = topk_search.top_k(data, lambda i: i % 20 == 0, start_rows=start).collect()
    least = min(v for _, v in own)
    want = brute_top([(0, least), *rows], lambda i: i == 0)
    others = brute_top(own + rows, lambda i: i % 20 == 0 and i > 0)
    assert len(want) == 20 and Counter(map(tuple, got)) == want + others


def test_top_k_of_large_components_is_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**10, 7.0]])
    assert topk_search.products(a, b).tolist() == [[2**60 + 3, 2**50 + 21]]
    with pytest.raises(OverflowError):
        topk_search.products(a * 2**20, b * 2**20)


# -- pipeline


def test_pipeline_stages(llm, make_docs, tmp_path):
    """Each stage against a plain version of its decision, on documents with nulls, copies and repeated rows."""
    docs = table(llm, SF, "documents").limit(150)
    body = docs.where("n_chars > 1500").limit(1).collect()[0]["text"]
    item = table(llm, SF, "benchmark").limit(1).collect()[0]["text"]
    more = make_docs([(9001, body), (9002, body + " end"), (9003, body[:400] + " " + item), (9004, None), (9005, ""), (None, "word " * 40), (9006, "mail jo@corp.org " + body[:700][::-1]), (9006, "mail jo@corp.org " + body[:700][::-1])])
    docs = docs.unionByName(more).withColumn("extra", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("kept"))
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen
        before.write.parquet(str(tmp_path / name))
        before = llm.read.parquet(str(tmp_path / name))
        seen = stage(llm, before, SF)
        assert seen.columns == before.columns, name
        old, new = [tuple(r) for r in before.collect()], [tuple(r) for r in seen.collect()]
        if name == "quality":
            model = quality_cnn.train(before, table(llm, SF, "labels"))
            scores = quality_cnn.score(model, [(r[1] or "").encode() for r in old])
            assert Counter(new) == Counter(r for r, s in zip(old, scores, strict=True) if s >= 0.3)
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).collect()
            assert sorted((r[0] is None, r[0] or 0) for r in new) == sorted({(r["component_id"] is None, r["component_id"] or 0) for r in groups})
            assert set(new) <= set(old)
        if name == "decontamination":
            from test_text_ops import brute_hits

            items = [tuple(r) for r in table(llm, SF, "benchmark").select("item_id", "text").collect()]
            assert Counter(new) == Counter(r for r in old if not brute_hits(r[1], items)[4])
        if name == "pseudonyms":
            assert Counter(r[0] for r in new) == Counter(r[0] for r in old)
            changed = {r[0]: r for r in new if r not in old}
            assert 9006 in changed and "jo@corp.org" not in changed[9006][1] and all(r[4] == len(r[1]) for r in changed.values())
        assert len(new) > 60
    pieces = corpus_pipeline.STAGES[-1][1](llm, seen, SF)
    assert pieces.columns == packing.pack(seen, public_tokenizers.path("byte_bpe_50k.json")).columns
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in new}


def test_pipeline_of_no_documents(llm, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, SF)
        assert docs.count() == 0
        docs = make_docs([])
