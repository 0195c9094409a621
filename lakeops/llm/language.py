"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public
vocabulary. The probability of a word is the sum, over all ways to cut it
into pieces, of the product of the pieces' probabilities (forward
algorithm); a text's score is the product over its words. Piece
probabilities are learned by EM (forward-backward over the words of each
language), as Spark jobs over a table of word counts.

``fit_language`` learns on about ``per_language`` documents of each language
(chosen by a hash of the id, documents over ``max_chars`` left out, so the
sample is bounded); ``identify_language`` scores every whole text.

Defined results: a null text or one without a letter is ``und`` with score
0.0, and so is every text if nothing was learned; null languages and null
ids teach nothing; ties go to the first language in name order; repeated
rows repeat their result; an empty table gives an empty table. Only the
named columns are read, so extra columns of any name are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import KeyTable, filter_rows, held_out, id_text, share_of, slices
from lakeops.session import materialize

WORDS = regex.compile(r"\p{L}+").findall
START = "▁"
#: Probability of a character outside the vocabulary; added count of each piece.
UNKNOWN, SMOOTH = 1e-7, 0.02
#: Words up to this length are scored in blocks; longer ones with rescaling.
SHORT, BLOCK, MEMO_ENTRIES, MEMO_CHARS = 40, 4096, 200_000, 40
UND = "und"


def read_pieces(model_path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the word-start mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in found if (t := p.removeprefix(START)) and t.isalpha() and t == t.lower())


@dataclass
class LanguageModel:
    languages: list
    pieces: list           # index i has row i + 1 of probs; row 0 is a character outside the vocabulary
    probs: np.ndarray      # pieces + 1 x languages

    def __post_init__(self):
        node: dict[str, int] = {"": 0}  # of the pieces' trie, by prefix
        steps: dict[int, int] = {}
        for p in self.pieces:
            for k in range(1, len(p) + 1):
                if p[:k] not in node:
                    node[p[:k]] = len(node)
                    steps[node[p[: k - 1]] << 21 | ord(p[k - 1])] = node[p[:k]]
        self.row = np.zeros(len(node), "i8")  # a node's piece; 0: none
        self.row[[node[p] for p in self.pieces]] = np.arange(1, len(self.pieces) + 1)
        self.step, self.reach = KeyTable(steps, -1), max(map(len, self.pieces), default=1)
        self.rows: dict[str, int] = {}  # memo: word -> row of its scores
        self.scores = np.zeros((0, len(self.languages)))

    def __reduce__(self):
        return LanguageModel, (self.languages, self.pieces, self.probs)

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the marked words, and the arcs (end, word, start, row of the
        piece) of all their cuttings, by end and word. All starts walk down
        the trie together."""
        chars = np.frombuffer((START + START.join(words) + START).encode("utf-32-le"), "<u4").astype("i8")
        size = np.fromiter(map(len, words), "i8", len(words)) + 1
        first = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        at, state = np.arange(len(chars) - 1), np.zeros(len(chars) - 1, "i8")
        alone = np.ones(len(at), bool)  # no piece of one character
        found = []
        for k in range(1, self.reach + 1):
            # a mark begins the next word, and no piece has one inside
            state = self.step(state << 21 | chars[at + k - 1]).astype("i8")
            on = np.flatnonzero(state >= 0)
            at, state = at[on], state[on]
            hit = np.flatnonzero(self.row[state])
            found.append((at[hit], k, self.row[state[hit]]))
            if k == 1:
                alone[at[hit]] = False
            if not len(at):
                break
        alone = np.flatnonzero(alone)
        found.append((alone, 1, np.zeros(len(alone), "i8")))
        start = np.concatenate([a for a, _, _ in found])
        row = np.concatenate([r for _, _, r in found])
        k = word[start]
        i = start - first[k]
        j = i + np.repeat([n for _, n, _ in found], [len(a) for a, _, _ in found])
        order = np.argsort(j * len(words) + k, kind="stable")
        return size, np.stack([j, k, i, row])[:, order]

    @staticmethod
    def _sums(n: int, seed: np.ndarray, arcs: np.ndarray, probs: np.ndarray, back: bool) -> np.ndarray:
        """Forward sums by end (or backward ones by start) of all words."""
        to, k, of, row = arcs
        cut = np.searchsorted(-to if back else to, -np.arange(n - 1, -2, -1) if back else np.arange(1, n + 1))
        for place, a, b in zip(range(n - 2, -1, -1) if back else range(1, n), cut[1:] if back else cut, cut[2:] if back else cut[1:]):
            if a < b:
                first = np.flatnonzero(np.diff(k[a:b], prepend=-1))  # arcs of a word stand together
                seed[place, k[a:b][first]] += np.add.reduceat(seed[of[a:b], k[a:b]] * probs[row[a:b]], first, axis=0)
        return seed

    def _forward(self, size: np.ndarray, arcs: np.ndarray, probs: np.ndarray) -> np.ndarray:
        alpha = np.zeros((int(size.max()) + 1, len(size), probs.shape[1]))
        alpha[0] = 1
        return self._sums(len(alpha), alpha, arcs, probs, False)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        while order and len(words[order[-1]]) > SHORT:
            i = order.pop()
            out[i] = self._long(words[i])
        for at in range(0, len(order), BLOCK):
            block = order[at : at + BLOCK]
            size, arcs = self.lattice([words[i] for i in block])
            out[block] = np.log(self._forward(size, arcs, self.probs)[size, np.arange(len(block))])
        return out

    def _long(self, word: str) -> np.ndarray:
        _, (end, _, start, row) = self.lattice([word])
        cut = np.searchsorted(end, np.arange(1, len(word) + 3)).tolist()
        alpha, scale = np.zeros((len(word) + 2, len(self.languages))), np.zeros(len(self.languages))
        alpha[0] = 1
        for j in range(1, len(alpha)):
            arcs = slice(cut[j - 1], cut[j])
            alpha[j] = (alpha[start[arcs]] * self.probs[row[arcs]]).sum(0)
            if j % 16 == 0:  # bring all that is still needed back to size
                near = slice(max(0, j - self.reach), j + 1)
                top = alpha[near].max(0)
                scale += np.log(top)
                alpha[near] /= top
        return np.log(alpha[-1]) + scale

    def expected(self, words: list[str], times: np.ndarray, lang: int) -> np.ndarray:
        """Expected uses of each row in the words (forward-backward)."""
        probs, total = self.probs[:, [lang]], np.zeros(len(self.probs))
        order = np.argsort(list(map(len, words)), kind="stable")
        for at in range(0, len(order), BLOCK):
            block = order[at : at + BLOCK]
            size, arcs = self.lattice([words[i] for i in block])
            alpha = self._forward(size, arcs, probs)
            beta = np.zeros_like(alpha)
            beta[size, np.arange(len(size))] = 1
            j, k, i, row = arcs
            back = np.argsort(-i * len(size) + k, kind="stable")
            beta = self._sums(len(beta), beta, np.stack([i, k, j, row])[:, back], probs, True)
            whole = alpha[size, np.arange(len(size)), 0]
            use = alpha[i, k, 0] * probs[row, 0] * beta[j, k, 0] / np.maximum(whole[k], 1e-300) * times[block][k]
            total += np.bincount(row, use, len(total))
        return total

    def score_many(self, texts: list) -> list[tuple[str, float]]:
        split = [WORDS(t.lower()) if t else () for t in texts]
        if len(self.rows) > MEMO_ENTRIES:
            self.rows.clear()
            self.scores = self.scores[:0]
        missing = list(set().union(*split).difference(self.rows))
        if missing and self.languages:
            self.rows.update(zip(missing, range(len(self.scores), len(self.scores) + len(missing))))
            self.scores = np.concatenate([self.scores, self.word_scores(missing)])
        out = []
        for words in split:
            if not words or not self.languages:
                out.append((UND, 0.0))
                continue
            total = self.scores[[self.rows[w] for w in words]].sum(0)
            best = int(total.argmax())
            out.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        for w in missing:
            if len(w) > MEMO_CHARS:
                self.rows.pop(w, None)
        return out


def fit_language(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 300, max_chars: int = 16_000, max_languages: int = 256, rounds: int = 3, max_word: int = 40) -> LanguageModel:
    """Learns on at most about ``per_language`` documents of a language, of up to
    ``max_chars`` characters, and on their words of up to ``max_word`` letters
    (longer ones are scored like others, but teach nothing). More than ``max_languages`` different values are an error."""
    known = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where("id is not null and lang is not null and text is not null").where(~held_out("id"))
    count = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(count) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages, pieces = sorted(count), read_pieces(model_path)
    probs = np.full((len(pieces) + 1, len(languages)), 1 / max(len(pieces), 1))
    probs[0] = UNKNOWN
    model = LanguageModel(languages, pieces, probs)
    if not languages:
        return model
    share = F.lit(0.0)
    for lang, n in count.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    sample = known.where(share_of("id", share)).where(F.length("text") <= max_chars)

    def count_words(batches):
        for batch in batches:
            for part in slices(batch):
                seen = Counter((lang, w) for text, lang in zip(*(c.to_pylist() for c in part.columns)) for w in WORDS(text.lower()) if len(w) <= max_word)
                if seen:
                    langs, words = zip(*seen)
                    yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(seen.values()))], ["lang", "word", "n"])

    words = sample.select("text", "lang").mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(words, "language-words")  # read by every round
    spark, place = df.sparkSession, {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)  # the vocabulary's size x languages

        def expect(batches):
            model, total = sent.value, {}
            for batch in batches:
                lang, word, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                for name in np.unique(lang):
                    mine = lang == name
                    total[name] = total.get(name, 0) + model.expected(word[mine].tolist(), n[mine], place[name])
            for name, uses in total.items():
                rows = np.flatnonzero(uses)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), place[name], "i4")), pa.array(rows.astype("i4")), pa.array(uses[rows])], ["lang", "piece", "n"])

        # no more rows than pieces x languages
        found = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(probs.shape, SMOOTH)
        for r in found:
            counts[r.piece, r.lang] += r.n
        probs = counts / counts[1:].sum(0)
        probs[0] = UNKNOWN
        model = LanguageModel(languages, pieces, probs)
    return model


def identify_language(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the likeliest language and its share of the
    probability of all learned languages."""
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = sent.value.score_many
        for batch in batches:
            for part in slices(batch):
                lang, value = zip(*score(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(value, pa.float64())], ["id", "lang_pred", "score"])

    out = src.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")


def drop_unidentified(df: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, all columns as they are, whose text has a language with a
    score of ``least`` or more."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def keeps():
        score = sent.value.score_many
        return lambda texts: [lang != UND and value >= least for lang, value in score(texts)]

    return filter_rows(df, text_col, keeps)
