"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word, with the word-start mark before it, is cut by
taking the longest piece of the vocabulary again and again. The vocabulary is a
trie whose nodes have a failure link (the node for what is left once the
pieces that must come off are popped) and the number of pieces popped on the
way, both worked out beforehand; so a word is counted in one pass over its
characters, without trying again and without building the pieces. A word
with a stretch that no piece begins counts as one unknown token.

Defined results: a null text, an empty one or one of white space has no word
and no token; repeated rows repeat their result; an empty table gives an empty
table. Only the named columns are read, so extra columns of any name are
ignored. Texts are taken whole, words of any length too.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import id_text, slices

START = "▁"
#: Entries after which a worker's memo of counted words starts anew, and its longest word.
MEMO_ENTRIES, MEMO_CHARS = 400_000, 40


def read_vocabulary(model_path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model (no control or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class LongestMatch:
    """Trie nodes as numbers: ``steps`` (a dict of characters to nodes),
    ``fail`` (-1: none) and ``popped``."""

    def __init__(self, vocabulary: list[str]):
        self.steps: list[dict] = [{}]
        is_piece, parent, char, order = [False], [-1], [""], []
        for piece in vocabulary:
            node = 0
            for c in piece:
                if c not in self.steps[node]:
                    self.steps[node][c] = len(self.steps)
                    self.steps.append({})
                    is_piece.append(False)
                    parent.append(node)
                    char.append(c)
                node = self.steps[node][c]
            if node:
                is_piece[node] = True
        self.fail, self.popped = [-1] * len(self.steps), [0] * len(self.steps)
        level = list(self.steps[0].values())
        while level:
            order += level
            level = [n for v in level for n in self.steps[v].values()]
        for v in order:  # parents come first
            if is_piece[v]:
                self.fail[v], self.popped[v] = 0, 1
                continue
            u = parent[v]
            z, n = self.fail[u], self.popped[u]
            while z >= 0 and char[v] not in self.steps[z]:
                n += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.steps[z][char[v]], n
        self.memo: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the marked word; 0 if it can't be cut into pieces."""
        steps, fail, popped = self.steps, self.fail, self.popped
        node = total = 0
        for c in word:
            while (to := steps[node].get(c)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = to
        while node > 0:
            total += popped[node]
            node = fail[node]
        return total if node == 0 else 0

    def count_many(self, texts: list) -> list[tuple[int, int, int]]:
        """(words, tokens, unknown words) of each text."""
        split = [t.split() if t else () for t in texts]
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        missing = set().union(*split).difference(memo)
        for w in missing:
            memo[w] = self.count(START + w)
        out = []
        for words in split:
            found = [memo[w] for w in words]
            unknown = found.count(0)
            out.append((len(words), sum(found) + unknown, unknown))
        for w in missing:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, n_unknown), one row per input row."""
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))  # a vocabulary: fixed size

    def run(batches):
        automaton = LongestMatch(sent.value)
        for batch in batches:
            for part in slices(batch):
                cols = zip(*automaton.count_many(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["id", "n_words", "n_tokens", "n_unknown"])

    out = src.mapInArrow(run, f"id {kind}, n_words long, n_tokens long, n_unknown long")
    return out.select(F.col("id").alias(id_col), "n_words", "n_tokens", "n_unknown")
