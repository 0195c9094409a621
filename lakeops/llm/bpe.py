"""BPE encoding and decoding with contiguous rank arrays.

``bpe_encode`` turns texts into token ids exactly as the tokenizers library
does for a byte-level BPE model with word ends (NFC, lower case, white space
dropped, special tokens matched in the raw text); ``bpe_decode`` turns ids
back into the text the library's ``decode`` gives when the model names no
decoder (token strings joined by one space).

Method: a word is a list of part ids and, beside it, one contiguous array
with the merge rank of each adjacent pair. The smallest rank is searched by
scanning the array (leftmost on ties), its boundary is deleted and the two
neighbouring ranks are looked up again. A scan costs the word's length, so
words over ``LONG_WORD`` parts use a heap over the same ranks, with the same
result in n log n. Words repeat a great deal, so each Python worker keeps a
bounded memo of encoded words.

Defined results: a null or empty text (or one of only white space) has no
ids and decodes to the empty string; null ids decode to the empty string;
repeated rows give repeated results; an empty table gives an empty table
with the same schema. Only the named columns are read, so extra columns of
any name are ignored. Texts are processed whole. Character classes and case
are those of the installed regex module and Python; the library's own tables
differ for some characters that Unicode added after version 15.1.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import KeyTable, id_text, slices

#: Words of more parts go to the heap; words of a step are handled together in blocks of ``BLOCK``.
LONG_WORD, BLOCK = 64, 4096
#: Longest word kept in the memo, and entries after which the memo starts anew.
MEMO_CHARS, MEMO_ENTRIES = 40, 250_000
NONE = np.int32(1 << 30)


def _byte_chars() -> list[str]:
    """The printable stand-in character of each byte in a byte-level vocabulary."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class WordBPE:
    """Encoder and decoder for one tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"] or ""
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        merged = [vocab[a + b] for a, b in pairs]
        self.ranks = {vocab[a] << 20 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}  # of a left and a right id
        self.merged = np.array([*merged, 0], "i4")  # rank -> id of the merged part
        self.rank_of = KeyTable(self.ranks, int(NONE))
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], "i4")
        self.last = np.array([vocab[c + end] for c in chars], "i4")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s of the library's engine is the White_Space property
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.ascii_pieces = re.compile(pattern.replace(r"\s", r"\t-\r ").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")).findall
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words: dict = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.rank_of(left.astype("i8") << 20 | right)

    # -- words ------------------------------------------------------------

    def _add_words(self, words) -> None:
        """Encode words that the memo lacks: rows of one matrix of parts and
        one of ranks, a merge in every row at each step."""
        words = list(words)
        raw = list(map(str.encode, words))
        size = np.fromiter(map(len, raw), "i8", len(raw))
        order = np.argsort(size, kind="stable").tolist()
        short = int((size <= LONG_WORD).sum())
        for at in range(0, short, BLOCK):
            block = order[at : min(at + BLOCK, short)]
            self.words.update(zip([words[i] for i in block], self._scan([raw[i] for i in block], size[block])))
        for i in order[short:]:
            b = np.frombuffer(raw[i], "u1")
            self.words[words[i]] = np.array(self._heap([*self.inner[b[:-1]].tolist(), int(self.last[b[-1]])]), "<u4").tobytes()

    def _scan(self, raw: list[bytes], size: np.ndarray) -> list[bytes]:
        width = int(size[-1])
        parts = np.zeros((len(raw), width), "i4")
        flat = np.frombuffer(b"".join(raw), "u1")
        ends = np.cumsum(size) - 1
        ids = self.inner[flat]
        ids[ends] = self.last[flat[ends]]
        parts[np.arange(width) < size[:, None]] = ids
        ranks = np.full(parts.shape, NONE, "i4")  # of a part and the next one
        if width > 1:
            ranks[:, :-1] = np.where(np.arange(1, width) < size[:, None], self._rank(parts[:, :-1], parts[:, 1:]), NONE)
        done, length, live = np.zeros(parts.shape, "<u4"), size.copy(), np.arange(len(raw))
        while len(live):
            at = ranks.argmin(1)
            low = ranks[np.arange(len(live)), at]
            over = low == NONE
            if over.any():
                done[live[over], : parts.shape[1]] = parts[over]
                length[live[over]] = size[over]
                keep = np.flatnonzero(~over)
                live, parts, ranks, size, at, low = live[keep], parts[keep], ranks[keep], size[keep], at[keep], low[keep]
                if not len(live):
                    break
            row = np.arange(len(live))
            parts[row, at] = self.merged[low]
            # delete the boundary: what lies right of it moves one place left
            col = np.arange(parts.shape[1] - 1, dtype="i2")
            gone = at.astype("i2")[:, None]
            ranks = np.where(col >= gone, ranks[:, 1:], ranks[:, :-1])
            parts = np.where(col > gone, parts[:, 1:], parts[:, :-1])
            size = size - 1
            if parts.shape[1] > int(size[-1]):
                parts, ranks = parts[:, : size[-1]], ranks[:, : size[-1]]
            ranks[row, np.minimum(at, size - 1)] = NONE
            for where, a in ((at > 0, at - 1), (at < size - 1, at)):  # the two neighbours
                r, a = row[where], a[where]
                ranks[r, a] = self._rank(parts[r, a], parts[r, a + 1])
        flat = done[np.arange(width) < length[:, None]].tobytes()
        ends = (np.cumsum(length) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _heap(self, parts: list[int]) -> list[int]:
        n, merged = len(parts), self.merged.tolist()
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if parts[i] < 0 or j >= n or self.ranks.get(parts[i] << 20 | parts[j]) != rank:
                continue  # an entry from before a merge beside it
            parts[i], parts[j] = merged[rank], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := self.ranks.get(parts[i] << 20 | parts[right[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if left[i] >= 0 and (r := self.ranks.get(parts[left[i]] << 20 | parts[i])) is not None:
                heapq.heappush(heap, (r, left[i]))
        return [p for p in parts if p >= 0]

    # -- texts ------------------------------------------------------------

    def _pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens, lower-cased."""
        if text.isascii():
            return self.ascii_pieces(text.lower())
        text = unicodedata.normalize("NFC", text)
        # the library lowers each character by itself: no final sigma
        return self.pieces(text.lower() if "Σ" not in text else "".join(c.lower() for c in text))

    def _parts(self, text: str) -> list:
        """Words of a text; special tokens as their ids."""
        if self.at_special and self.at_special.search(text):
            return [x for p in self.at_special.split(text) if p for x in ([self.special[p]] if p in self.special else self._pieces(p))]
        return self._pieces(text)

    def encode_many(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self._parts(t) if t else () for t in texts]
        words = self.words
        if len(words) > MEMO_ENTRIES:
            words.clear()
        missing = set().union(*split).difference(words)
        if missing:
            for i in [i for i in missing if isinstance(i, int)]:
                words[i] = i.to_bytes(4, "little")
                missing.discard(i)
            self._add_words(missing)
        out = [b"".join([words[w] for w in ws]) for ws in split]
        for w in missing:
            if len(w) > MEMO_CHARS:
                del words[w]
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], "<u4").tolist()

    def decode(self, ids) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    def decode_many(self, ids: pa.ListArray) -> list[str]:
        get, at, flat = self.tokens.__getitem__, ids.offsets.to_pylist(), ids.values.to_numpy()
        return [" ".join(map(get, flat[a:b].tolist())) for a, b in zip(at, at[1:])]


_MADE: dict[str, WordBPE] = {}


def coder(spec: str) -> WordBPE:
    """One coder per worker process and tokenizer."""
    if spec not in _MADE:
        _MADE.clear()
        _MADE[spec] = WordBPE(spec)
    return _MADE[spec]


def read_spec(tokenizer_path: str) -> str:
    """The tokenizer file's text, sent to the executors with the tasks (a
    vocabulary file: a fixed few MB, whatever the data)."""
    with open(tokenizer_path, encoding="utf-8") as fh:
        return fh.read()


def bpe_encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """(id, text) -> (id, ids array<int>), one row per input row; with
    ``decode`` also what the ids decode to, in the same pass."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()

    def run(batches):
        bpe = coder(spec.value)
        for batch in batches:
            for part in slices(batch):
                found = bpe.encode_many(part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, found)]) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(np.frombuffer(b"".join(found), "<i4")))
                more = [pa.array(bpe.decode_many(ids), pa.string())] * decode
                yield pa.RecordBatch.from_arrays([part.column(0), ids, *more], ["id", "ids", "decoded"][: 2 + decode])

    out = src.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decode)
    return out.select(F.col("id").alias(id_col), *out.columns[1:])


def bpe_decode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids) -> (id, ids, decoded string), one row per input row."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    src = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches):
        bpe = coder(spec.value)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bpe.decode_many(part.column(1)), pa.string())], ["id", "ids", "decoded"])

    out = src.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>"))).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), F.col("ids").alias(ids_col), "decoded")
