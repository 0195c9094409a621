"""Toxicity by multiple-instance learning.

Labels say which documents are toxic, not which sentences. Each sentence gets
a logistic score over the words in it; a document's score is the noisy-or of
its sentences, 1 - prod(1 - p). The word weights are trained through that
product from document labels alone, and then point at the offending
sentences.

``fit_toxicity`` learns on at most about ``per_class`` labelled documents of
each class (chosen by a hash of the id; documents over ``max_chars`` are not
used for training, so the sample is bounded in bytes); class weights restore
the true class shares. ``score_toxicity`` scores every whole text.

Defined results: a null text, an empty one or one without words scores 0.0
and has no offending sentence; null labels and null ids teach nothing; with no
training row, or only one class, every text scores next to 0 (2e-9 a sentence,
what the untrained bias gives); repeated rows repeat
their result; an empty table gives an empty table. Only the named columns are
read, so extra columns of any name are ignored.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import filter_rows, held_out, id_text, share_of, slices

#: A word, or the end of a sentence.
TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]").findall
SENTENCES = re.compile(r"[^.!?\n]+").finditer
ENDS = dict.fromkeys(".!?\n")


@dataclass
class ToxicityModel:
    bias: float = -20.0
    weights: dict = field(default_factory=dict)

    def sentence_logits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of each sentence that has a word."""
        get = self.weights.get
        return [(m.start(), m.end(), self.bias + sum({w: get(w, 0.0) for w in words}.values()))
                for m in SENTENCES(text) if (words := TOKENS(m.group().lower()))]

    def score_many(self, texts: list) -> np.ndarray:
        """Noisy-or of the sentence scores of each text."""
        base = np.log1p(np.exp(self.bias))
        get, ends, out = self.weights.get, ENDS, np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not text:
                continue
            lowered = text.lower()
            tokens = TOKENS(lowered)
            known = [k for k in set(tokens) if get(k)]
            words = len(tokens) and any(t not in ends for t in tokens)
            if not words:
                continue
            if not known:  # every sentence scores the bias alone
                total = base * _sentences(tokens, ends)
            else:
                z = np.array([s[2] for s in self.sentence_logits(lowered)])
                total = np.logaddexp(0, z).sum()
            out[i] = -np.expm1(-total)
        return out


def _sentences(tokens: list[str], ends) -> int:
    """Sentences with a word among the tokens."""
    n, open_ = 0, False
    for t in tokens:
        if t in ends:
            n, open_ = n + open_, False
        else:
            open_ = True
    return n + open_


def _features(texts: list[str], min_docs: int) -> tuple[list[str], list[np.ndarray], np.ndarray, np.ndarray]:
    """Vocabulary; word ids of all sentences in a row, sentence starts, the document of each sentence."""
    seen: dict[str, int] = {}
    for text in texts:
        for w in set(TOKENS(text.lower())).difference(ENDS):
            seen[w] = seen.get(w, 0) + 1
    vocabulary = sorted(w for w, n in seen.items() if n >= min_docs)
    ids = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: the bias
    # numbers only, not the sentences' words: the sample may be tens of MB
    flat, starts, doc = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for m in SENTENCES(text.lower()):
            if words := TOKENS(m.group()):
                starts.append(len(flat))
                doc.append(d)
                flat.append(0)
                flat.extend({ids[w] for w in words if w in ids})
    return vocabulary, np.frombuffer(flat, "i4"), np.frombuffer(starts, "i4"), np.frombuffer(doc, "i4")


def fit_noisy_or(texts: list[str], labels: np.ndarray, weight: np.ndarray, min_docs: int = 3, steps: int = 300, l1: float = 0.5, l2: float = 0.02) -> ToxicityModel:
    """Adam on the document log-loss of the noisy-or, from labels alone.

    The noisy-or has one more cause beside the sentences, a leak that no
    text explains: it takes up wrongly labelled documents and is not part of
    a score. Word weights are not negative, and a word has to explain more
    than ``l1`` documents to get any."""
    vocabulary, flat, starts, doc = _features(texts, min_docs)
    if not len(starts) or len(set(labels.tolist())) < 2:
        return ToxicityModel()
    n = len(texts)
    size = np.diff(np.append(starts, len(flat)))
    per_doc = np.bincount(doc, minlength=n)
    weight = weight / weight[labels == 1].mean()
    share = float((weight * labels).sum() / weight.sum())
    # one vector: log of the leak's rate, the bias, the words
    w = np.zeros(len(vocabulary) + 2)
    w[0] = np.log(max(share, 1e-6) / 2)
    w[1] = np.log(max(share, 1e-6) / max(per_doc.mean(), 1.0)) - 2
    # words start at the log ratio of their shares of toxic and clean documents
    pairs = np.unique(np.repeat(doc.astype("i8"), size) * len(w) + flat)
    at, toxic = pairs % len(w), labels[pairs // len(w)] == 1
    here = [np.bincount(at[x], weight[pairs // len(w)][x], len(w) - 1)[1:] for x in (toxic, ~toxic)]
    pos, neg = float(weight[labels == 1].sum()), float(weight[labels == 0].sum())
    w[2:] = np.clip(np.log((here[0] + 0.1) / (pos + 1) / ((here[1] + 0.5) / (neg + 1))), 0, 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.add.reduceat(w[1:][flat], starts)
        p = 1 / (1 + np.exp(-z))
        leak = np.exp(w[0])
        total = np.bincount(doc, np.logaddexp(0, z), n) + leak
        by_doc = np.where(labels == 1, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0) * weight
        g = np.empty_like(w)
        g[0] = by_doc.sum() * leak
        g[1:] = np.bincount(flat, np.repeat(by_doc[doc] * p, size), len(w) - 1)
        g[2:] += l1 + l2 * w[2:]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        np.maximum(w[2:], 0, out=w[2:])
    keep = np.flatnonzero(w[2:] > 0.1)
    return ToxicityModel(float(w[1]), {vocabulary[i]: float(w[i + 2]) for i in keep})


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, max_chars: int = 16_000) -> ToxicityModel:
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    count = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return ToxicityModel()
    share = {k: min(1.0, per_class / n) for k, n in count.items()}
    chosen = known.where(share_of("id", F.when(F.col("label") == 1, share[1]).otherwise(share[0])))
    sample = (id_text(docs, id_col, text_col).where(F.length("text").between(1, max_chars))
              .join(F.broadcast(chosen), "id")  # at most about 2 x per_class ids, as chosen above
              .select("label", "text", F.xxhash64("id").alias("h")).collect())
    sample.sort(key=lambda r: (r.h, r.text))
    y = np.array([r.label for r in sample])
    seen = np.bincount(y, minlength=2) if len(y) else np.zeros(2)
    weight = np.array([count[k] / seen[k] for k in y])
    texts = [r.text for r in sample]
    del sample
    return fit_noisy_or(texts, y, weight)


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, score, offending): ``offending`` holds start, end (characters)
    and score of each sentence of 0.5 or more in a document that reaches
    the threshold."""
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)  # at most the sample's vocabulary
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        model = sent.value
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                score = model.score_many(texts)
                found = [[{"start": a, "end": b, "score": float(1 / (1 + np.exp(-z)))} for a, b, z in model.sentence_logits(t) if z >= 0] if s >= threshold else [] for t, s in zip(texts, score)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(found, spans)], ["id", "score", "offending"])

    out = src.mapInArrow(run, f"id {kind}, score double, offending array<struct<start:int,end:int,score:double>>")
    return out.select(F.col("id").alias(id_col), "score", "offending")


def drop_toxic(df: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows, all columns as they are, whose text scores under the threshold."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def keeps():
        model = sent.value
        return lambda texts: (model.score_many(texts) < threshold).tolist()

    return filter_rows(df, text_col, keeps)
