"""Toxicity and language models: the formulas against brute force, accuracy on held-out rows."""

import zlib
from itertools import product

import numpy as np
import pytest

from lakeops.llm.common import tokenizer
from lakeops.llm.language import UNKNOWN, LanguageModel, drop_unidentified, fit_language, identify_language
from lakeops.llm.toxicity import ToxicityModel, drop_toxic, fit_noisy_or, fit_toxicity, score_toxicity
from llm_edges import EDGES

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


def test_score_is_the_noisy_or_of_the_sentences():
    model = ToxicityModel(-4.0, {"bad": 6.0, "worse": 2.0})
    texts = ["Good day. Bad bad thing! worse\nNothing.", "quiet", "", None, "...", "12 34"]
    p = lambda z: 1 / (1 + np.exp(-z))
    want = [1 - (1 - p(-4)) * (1 - p(2)) * (1 - p(-2)) * (1 - p(-4)), p(-4), 0, 0, 0, 0]
    assert np.allclose(model.score_many(texts), want)
    spans = [(texts[0][a:b].strip(), round(z, 6)) for a, b, z in model.sentence_logits(texts[0])]
    assert spans == [("Good day", -4), ("Bad bad thing", 2), ("worse", -2), ("Nothing", -4)]


def test_training_finds_the_words_behind_document_labels():
    """A tenth of the labels is wrong; only the toxic word gets weight."""
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(600):
        sentences = [" ".join(f"w{j}" for j in rng.integers(0, 300, 8)) for _ in range(6)]
        toxic = i % 5 == 0
        if toxic:
            sentences[rng.integers(6)] += " nasty"
        texts.append(". ".join(sentences))
        labels.append(int(toxic) if rng.random() > 0.1 else int(not toxic))
    model = fit_noisy_or(texts, np.array(labels), np.ones(600))
    assert max(model.weights, key=model.weights.get) == "nasty"
    scores = model.score_many(texts)
    toxic = np.arange(600) % 5 == 0
    assert (scores[toxic] >= 0.7).mean() > 0.95 and (scores[~toxic] >= 0.7).mean() < 0.02
    assert fit_noisy_or(texts, np.zeros(600, int), np.ones(600)).weights == {}


def test_toxicity_on_held_out_rows(spark, mid):
    docs, labels = mid
    model = fit_toxicity(docs, labels)
    rows = score_toxicity(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    clean = [r.score for r in held if r.toxic == 0]
    toxic = [r.score for r in held if r.toxic == 1]
    auc = np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic])
    assert auc > 0.7 and np.mean(np.array(clean) >= 0.7) < 0.03
    # labels of the held-out third teach nothing
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    assert fit_toxicity(docs, flipped).weights == model.weights
    kept = drop_toxic(docs, model)
    assert kept.schema == docs.schema
    high = {r.doc_id for r in score_toxicity(docs, model).where("score >= 0.7").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - high


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = fit_toxicity(edge_docs, labels)
    rows = score_toxicity(edge_docs, ToxicityModel(-1.0, {"same": 5.0})).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (2, 3, 4)} == {0.0}
    assert all(r.offending for r in rows if r.doc_id in (6, 10)) and len({r.score for r in rows if r.doc_id in (6, 10)}) == 1
    assert score_toxicity(no_docs, model).count() == 0 and fit_toxicity(no_docs, labels.limit(0)) == ToxicityModel()
    assert drop_toxic(edge_docs, model).columns == edge_docs.columns


PIECES = ["▁", "▁a", "▁ab", "a", "b", "ab", "ba", "bab"]


def tiny():
    rng = np.random.default_rng(1)
    probs = rng.random((len(PIECES) + 1, 3))
    probs[0] = UNKNOWN
    return LanguageModel(["x", "y", "z"], sorted(PIECES), probs)


def brute(model, word):
    """Sum over every way to cut the marked word, and each piece's expected uses."""
    marked, n = "▁" + word, len(word) + 1
    rows = {p: i + 1 for i, p in enumerate(model.pieces)}
    total, uses = np.zeros(3), np.zeros_like(model.probs)
    for cuts in product([0, 1], repeat=n - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
        parts = [marked[a:b] for a, b in zip(at, at[1:])]
        if all(p in rows or len(p) == 1 for p in parts):
            path = [rows.get(p, 0) for p in parts]
            weight = model.probs[path].prod(0)
            total += weight
            for r in path:
                uses[r] += weight
    return total, uses / total


def test_forward_sums_all_segmentations():
    model = tiny()
    words = ["a", "b", "abab", "babba", "xay", "é", "bababab"]
    got = model.word_scores(words)
    for w, scores in zip(words, got):
        assert np.allclose(scores, np.log(brute(model, w)[0]))
        assert np.allclose(model._long(w), scores)
    for lang in range(3):
        times = np.arange(1.0, len(words) + 1)
        want = sum(n * brute(model, w)[1][:, lang] for w, n in zip(words, times))
        assert np.allclose(model.expected(words, times, lang), want)
    assert np.isfinite(model.word_scores(["ab" * 4000, "q" * 9000])).all()


def test_language_on_held_out_rows(spark, mid):
    docs, _ = mid
    model = fit_language(docs, tokenizer("piece_bpe_32k.model"), per_language=60)
    rows = identify_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98 and all(0 <= r.score <= 1 for r in rows)
    assert drop_unidentified(docs, model).count() == docs.count()


def test_language_edges(spark, edge_docs, no_docs):
    path = tokenizer("piece_bpe_32k.model")
    model = fit_language(edge_docs, path)
    rows = identify_language(edge_docs, model).collect()
    assert len(rows) == len(EDGES)
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 9)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 5, 6, 8, 10, None)} <= {"en"}
    kept = drop_unidentified(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == len(EDGES) - 4
    none = fit_language(no_docs, path)
    assert none.languages == [] and {r.lang_pred for r in identify_language(edge_docs, none).collect()} == {"und"}
    assert identify_language(no_docs, model).count() == 0
