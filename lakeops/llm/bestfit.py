"""Best-fit packing by exact complements.

Documents are encoded and an end id is put behind each; one longer than a
sequence is cut into whole sequences, its first piece taking the rest. Pieces
are then packed into as few sequences of ``length`` tokens as can be.

Method: packing needs only how many pieces there are of each length, at most
``length`` counts however large the corpus. From the longest down, a length's
gap is looked up among the single lengths, then the sums of two, then of
three, hashed by their sum; a combination found fills the gap exactly and is
consumed as often as the counts allow. What is left over is laid best fit, the
longest first, whole groups of equal sequences at a time.

Scale: texts are read and encoded once, the ids written in two or four bytes
each to the shared folder together with the piece's number among the pieces of
its length in its task. Adding the counts of the tasks before gives its number
among all pieces of its length, and the plan says where that number goes: a
piece finds its place by itself, so no sort and no task sees more than its own
rows. The plan holds a few entries for each length (not for each piece) and is
what is broadcast; the driver gets the counts.

Defined results: a null or empty text is its end id alone; a null id is packed
like any other; each of several rows with one id is packed by itself; pieces
of equal length are interchangeable and get places in the order of the written
table; an empty table gives an empty table. Only the named columns are read,
so extra columns of any name are ignored. Texts are packed whole.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, insort
from itertools import accumulate, chain, compress, count, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.bpe import NONE, WordBPE, _byte_chars
from lakeops.llm.common import KeyTable, id_text, slices
from lakeops.session import scratch_path

#: Words kept in a worker's memo, and the longest of them.
MEMO_ENTRIES, MEMO_CHARS = 600_000, 48
#: Rows of (length, task) that are broadcast (24 bytes each); more are joined by a shuffle.
MOST_SENT = 1_000_000
#: Characters below are split by one compiled pattern; a text with others goes to the library whole.
PLAIN = 0x250


class ByteBPE(WordBPE):
    """Ids of texts as the tokenizers library gives them for a byte-level
    vocabulary. Its word split is repeated here, and unseen words are merged
    all together by rank arrays (``lakeops.llm.bpe``); texts with special
    tokens or unusual letters go to the library whole."""

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        model = json.loads(spec)["model"]
        vocab, pairs = model["vocab"], [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.ranks = {vocab[a] << 20 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = np.array([*(vocab[a + b] for a, b in pairs), 0], "i4")
        self.rank_of = KeyTable(self.ranks, int(NONE))
        self.inner = self.last = np.array([vocab[c] for c in _byte_chars()], "i4")  # no word ends here
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        kind = {c: "".join(re.escape(chr(x)) for x in range(PLAIN) if regex.match(p, chr(x))) for c, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\p{White_Space}"))}
        # the split that the byte-level pre-tokenizer documents, its classes written out
        split = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
        self.split = re.compile(split.format(**kind)).findall
        self.unusual = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]").search
        self.words: dict[str, bytes] = {}

    def _odd(self, text: str) -> bool:
        """Whether a text is left to the library."""
        return any(t in text for t in self.special) or not text.isascii() and self.unusual(text) is not None

    def encode_many(self, texts: list) -> list[bytes]:
        """Ids of each text, little-endian, two or four bytes each."""
        memo = self.words
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        odd = [bool(t) and self._odd(t) for t in texts]
        split = [() if not t or o else self.split(t) for t, o in zip(texts, odd)]
        words = list(chain.from_iterable(split))
        found = list(map(memo.get, words))
        unseen = list(compress(count(), map(is_, found, repeat(None))))
        if unseen:
            new = {words[i] for i in unseen}
            self._add_words(new)
            for i in unseen:
                found[i] = memo[words[i]]
            for w in new:
                if len(w) > MEMO_CHARS:
                    del memo[w]
        ends = list(accumulate(map(len, split)))
        out = [np.frombuffer(b"".join(found[a:b]), "<u4").astype(self.width).tobytes() for a, b in zip([0, *ends], ends)]
        for i in [i for i, o in enumerate(odd) if o]:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, self.width).tobytes()
        return out


_MADE: dict[str, ByteBPE] = {}


def _coder(spec: str) -> ByteBPE:
    """One coder per worker process and tokenizer."""
    if spec not in _MADE:
        _MADE.clear()
        _MADE[spec] = ByteBPE(spec)
    return _MADE[spec]


# -- the plan: counts of lengths -> places ---------------------------------


class _Sums:
    """Available lengths hashed by the sums of one, two and three of them."""

    def __init__(self, counts: np.ndarray, most: int):
        self.counts, self.most = counts, most
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        there = np.flatnonzero(counts).tolist()
        for i, a in enumerate(there):
            for b in there[: i + 1]:
                if a + b < len(counts):
                    self.pairs.setdefault(a + b, []).append((a, b))

    def times(self, combination: tuple[int, ...]) -> int:
        """How often the counts allow a combination."""
        return min(int(self.counts[x]) // combination.count(x) for x in set(combination))

    def _pair(self, total: int, beside: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
        live = [p for p in self.pairs.get(total, ()) if self.counts[p[0]] and self.counts[p[1]]]
        if live:
            self.pairs[total] = live  # lengths never come back
        return max(((self.times((*beside, *p)), (*beside, *p)) for p in live), default=(0, ()))

    def filling(self, length: int) -> tuple[int, tuple[int, ...]]:
        """(times, combination) that fills a sequence exactly beside a piece
        of ``length``: of the fewest pieces, the one possible most often."""
        gap = len(self.counts) - 1 - length
        if gap == 0:
            return self.times((length,)), (length,)
        if self.counts[gap] and (n := self.times((length, gap))):
            return n, (length, gap)
        found = self._pair(gap, (length,)) if self.most > 1 else (0, ())
        if not found[0] and self.most > 2:
            thirds = np.flatnonzero(self.counts[: gap // 3 + 1]).tolist()
            found = max((self._pair(gap - c, (length, c)) for c in thirds), default=(0, ()))
        return found


def plan(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Places for all pieces, from the number of pieces of each length
    (``counts[n]`` for length n, the last the sequences' own length): the
    plan of fewest sequences among those whose gaps may be filled by up to
    three, two or one pieces (where few lengths occur, filling gaps with
    several short pieces can leave long ones without company). Returns runs (length, first, sequence, offset, beside) and the number of sequences:
    piece number ``first + i`` of the length lies in sequence ``sequence + i //
    beside`` at ``offset + i % beside * length``."""
    return min((_plan(counts, most) for most in (3, 2, 1)), key=lambda x: x[1])


def _plan(counts: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    counts = counts.astype("i8").copy()
    size, used = len(counts) - 1, np.zeros(len(counts), "i8")
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def lay(content: tuple[tuple[int, int], ...], times: int) -> None:
        """``times`` sequences that hold (length, how many) in this order."""
        nonlocal sequences
        at = 0
        for length, beside in content:
            runs.append((length, int(used[length]), sequences, at, beside))
            used[length] += times * beside
            at += length * beside
        sequences += times

    sums = _Sums(counts, most)
    for length in range(size, 0, -1):
        while counts[length]:
            times, found = sums.filling(length)
            if not times:
                break
            lay(tuple((x, found.count(x)) for x in dict.fromkeys(found)), times)
            for x in found:
                counts[x] -= times
    # what no combination filled: best fit, the longest first, by groups of equal sequences
    gaps: list[int] = []  # sorted
    groups: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}

    def put(gap: int, content: tuple[tuple[int, int], ...], times: int) -> None:
        if gap not in groups:
            groups[gap] = []
            insort(gaps, gap)
        groups[gap].append((content, times))

    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                beside = min(size // length, left)
                put(size - length * beside, ((length, beside),), left // beside)
                left %= beside
                continue
            gap = gaps[k]
            content, times = groups[gap].pop()
            beside = min(gap // length, left)
            n = min(times, left // beside)
            if n < times:
                groups[gap].append((content, times - n))
            if not groups[gap]:
                del groups[gap]
                gaps.pop(k)
            put(gap - length * beside, (*content, (length, beside)), n)
            left -= n * beside
    for found in groups.values():
        for content, times in found:
            lay(content, times)
    table = np.array(runs, "i8").reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))], sequences


# -- on Spark --------------------------------------------------------------


def pack_best_fit(df: DataFrame, tokenizer_path: str, end_id: int, length: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (id, piece, start, length, ids binary of
    little-endian uint32, sequence_id, offset)."""
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as fh:
        spec = spark.sparkContext.broadcast(fh.read())  # a vocabulary file: a fixed few MB
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()

    def encode(batches):
        bpe, seen, task = _coder(spec.value), np.zeros(length + 1, "i8"), TaskContext.get().partitionId()
        wide, end = np.dtype(bpe.width).itemsize, np.array([end_id], bpe.width).tobytes()
        for batch in batches:
            for part in slices(batch):
                row, piece, start, size, ids = [], [], [], [], []
                for k, doc in enumerate(bpe.encode_many(part.column(1).to_pylist())):
                    doc += end
                    total, at = len(doc) // wide, 0
                    to = total % length or length
                    while at < total:
                        row.append(k)
                        piece.append(0 if not at else piece[-1] + 1)
                        start.append(at)
                        size.append(to - at)
                        ids.append(doc[at * wide : to * wide])
                        at, to = to, to + length
                # number among the task's pieces of the length
                size = np.array(size, "i8")
                order = np.argsort(size, kind="stable")
                by = size[order]
                place = np.empty(len(size), "i8")
                place[order] = seen[by] + np.arange(len(by)) - np.searchsorted(by, by)
                seen += np.bincount(size, minlength=length + 1)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(np.full(len(size), task)), pa.array(place), pa.array(ids, pa.binary())], ["id", "piece", "start", "length", "task", "place", "ids"])

    path = scratch_path(spark, "bestfit-pieces")
    src.mapInArrow(encode, f"id {kind}, piece int, start long, length long, task long, place long, ids binary").write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    each = pieces.groupBy("length", "task").agg(F.max("place").alias("n")).withColumn("n", F.col("n") + 1)
    counts = np.zeros(length + 1, "i8")
    for n, total in each.groupBy("length").agg(F.sum("n")).collect():  # a row for each length, never more than ``length``
        counts[n] = total
    runs = spark.sparkContext.broadcast(plan(counts)[0])
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = each.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    if each.count() <= MOST_SENT:  # few tasks: the ids needn't be shuffled for it
        ahead = F.broadcast(ahead)
    numbered = pieces.join(ahead, ["length", "task"]).select("id", "piece", "start", "length", (F.col("place") + F.col("ahead")).alias("number"), "ids")
    width = _coder(spec.value).width

    def lay(batches):
        table = runs.value
        base = np.searchsorted(table[:, 0], np.arange(length + 2))
        for batch in batches:
            for part in slices(batch):
                size, number = (part.column(i).to_numpy() for i in (3, 4))
                at = np.empty(len(size), "i8")
                for n in np.unique(size).tolist():
                    of = size == n
                    at[of] = base[n] + np.searchsorted(table[base[n] : base[n + 1], 1], number[of], "right") - 1
                _, first, sequence, offset, beside = table[at].T
                ids = [np.frombuffer(b, width).astype("<u4").tobytes() for b in part.column(5).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(ids, pa.binary()), pa.array(sequence + (number - first) // beside), pa.array(offset + (number - first) % beside * size)], ["id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    out = numbered.mapInArrow(lay, f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return out.select(F.col("id").alias(id_col), *out.columns[1:])
