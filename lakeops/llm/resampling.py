"""Importance resampling towards a target distribution.

A feature is a run of up to ``max_words`` words (A-Z lower-cased; letters
outside ASCII count as word characters) joined by one space; its bucket is its
UTF-8 bytes' CRC32 modulo ``buckets``. A bucket's gain is the logarithm of its
share in the target over its share in the source, a document's weight the mean
of its features' gains, and the documents drawn are those with the highest
weight plus Gumbel noise, which is a draw without replacement in proportion to
the weights.

Method: head-tail vocabulary. A CRC32 can be carried on from its state, so the
state after each frequent word (the head) and the buckets of frequent pairs of
them are computed once and broadcast, exactly; a word or a run outside the head
(the tail) has its CRC taken directly, carried on from the run one word
shorter. Head and tail give the same buckets, so the head's choice changes
speed only; it is counted over all rows, at most ``head_words`` words and as
many pairs are kept. The totals, the weights and the draw cover every feature
of every row.

Scale: texts are read twice, for the head and for the features. Each row's buckets (two bytes a feature) go to the
shared folder, counted by task and bucket on the way; the totals are
``buckets`` rows whatever the data, so is what is broadcast. Scores are whole
numbers in a range fixed by the formula: counting them gives the score of the
last one drawn, and only rows that reach it are sorted, by ranges, and numbered
with each range's count of rows before it.

Defined results: a null or empty text has no feature, weight 0, and takes part
in the draw only if ``least_words`` is 0; a null id is hashed as an empty one
and comes first among ties; each of several rows with one id is scored and
drawn by itself; ties go to the smaller id; without any feature on either side
all gains are those of empty totals (0); an empty table gives an empty table.
Only the named columns are read, so extra columns of any name are ignored.
Texts are taken whole.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import KeyTable, id_text, slices, small_batches
from lakeops.session import materialize, scratch_path

#: Byte -> itself in lower case if it belongs to a word, a space if not.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
#: Tail words whose state a worker remembers.
MEMO_ENTRIES = 200_000
#: A pair's key holds two head numbers of so many bits.
HEAD_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class States(dict):
    """Word -> (number in the head or -1) << 32 | CRC32. Filled with the
    head, which is numbered in order; tail words are added as they come."""

    def __init__(self, head: list[bytes]):
        super().__init__((w, i << 32 | crc32(w)) for i, w in enumerate(head))
        self.head = len(head)

    def __missing__(self, word: bytes) -> int:
        if len(self) - self.head > MEMO_ENTRIES:
            for w in [w for w, v in self.items() if v < 0]:
                del self[w]
        self[word] = value = -1 << 32 | crc32(word)
        return value


class Features:
    """Buckets of the runs of words of texts."""

    def __init__(self, head: list[bytes], pairs: list[tuple[bytes, bytes]], max_words: int, buckets: int):
        if len(head) > 1 << HEAD_BITS:
            raise ValueError(f"the head holds at most {1 << HEAD_BITS} words")
        self.max_words, self.buckets = max_words, buckets
        self.states = States(head)
        key = {(self.states[a] >> 32) << HEAD_BITS | self.states[b] >> 32: crc32(b" " + b, crc32(a)) for a, b in pairs} if max_words > 1 else {}
        # the table holds 32-bit signed values: a state's bits as they are, and a number for those that are there
        self.pair_states = np.array([*key.values(), 0], "u8")
        self.pair_number = KeyTable({k: i for i, k in enumerate(key)}, -1) if key else None

    def of(self, words: list[list[bytes]]) -> list[np.ndarray]:
        """Each text's buckets: its single words', then its pairs', and so on."""
        size = np.fromiter(map(len, words), "i8", len(words))
        flat = [w for ws in words for w in ws]
        value = np.fromiter(map(self.states.__getitem__, flat), "i8", len(flat))
        number, state = value >> 32, (value & 0xFFFFFFFF).astype("u8")
        text = np.repeat(np.arange(len(words)), size)
        found, of = [state % self.buckets], [text]
        for n in range(2, self.max_words + 1):
            at = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.empty(0, "i8")
            longer = np.zeros(len(flat), "u8")
            todo = at
            if n == 2 and self.pair_number is not None and len(at):
                a, b = number[at], number[at + 1]
                got = np.where((a >= 0) & (b >= 0), self.pair_number(np.maximum(a, 0) << HEAD_BITS | np.maximum(b, 0)), -1)
                longer[at[got >= 0]] = self.pair_states[got[got >= 0]]
                todo = at[got < 0]
            longer[todo] = np.fromiter((crc32(b" " + flat[i + n - 1], s) for i, s in zip(todo.tolist(), state[todo].tolist())), "u8", len(todo))
            state = longer
            found.append(state[at] % self.buckets)
            of.append(text[at])
        every, of = np.concatenate(found).astype("<u4" if self.buckets > 1 << 16 else "<u2"), np.concatenate(of)
        every = every[np.argsort(of, kind="stable")]
        ends = np.cumsum(np.bincount(of, minlength=len(words)))
        return np.split(every, ends[:-1]) if len(words) else []


def frequent(df: DataFrame, text_col: str, max_words: int, keep: int) -> list[tuple[bytes, bytes | None]]:
    """At most ``keep`` frequent words and as many pairs (a word has no
    second part). All rows are counted; a task reports what makes at least
    one of ``keep`` of its words, as anything so frequent in all does
    somewhere, so it reports ``keep`` rows of a kind at most. What is missed
    is tail: this choice changes speed only, never a result."""
    src = df.select(F.col(text_col).cast("string").alias("text"))
    small_batches(df.sparkSession)

    def run(batches):
        counters, size = (Counter(), Counter()), 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    words = words_of(text)
                    size += len(words)
                    counters[0].update(words)
                    if max_words > 1:
                        counters[1].update(zip(words, words[1:]))
                for k, counter in enumerate(counters):
                    if len(counter) > 10 * keep:  # so far too rare
                        counters[k].clear() if not size else _drop(counter, size / keep / 2)
        for counter in counters:
            rows = [(w, None, n) if isinstance(w, bytes) else (*w, n) for w, n in counter.items() if n * keep >= size]
            if rows:
                a, b, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["word", "next", "n"])

    counted = src.mapInArrow(run, "word binary, next binary, n long").groupBy("word", "next").agg(F.sum("n").alias("n"))
    kinds = [F.col("next").isNull()] + [F.col("next").isNotNull()] * (max_words > 1)
    return [(bytes(r[0]), r[1] and bytes(r[1])) for of in kinds for r in counted.where(of).orderBy(F.desc("n"), "word", "next").limit(keep).collect()]


def _drop(counter: Counter, least: float) -> None:
    for w in [w for w, n in counter.items() if n < least]:
        del counter[w]


def feature_rows(df: DataFrame, features, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, buckets binary), one row per input row."""
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()

    def run(batches):
        make = _features(features)
        for batch in batches:
            for part in slices(batch):
                words = [words_of(t) for t in part.column(1).to_pylist()]
                found = make.of(words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(len, words)), pa.int64()), pa.array(list(map(len, found)), pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], ["id", "n_words", "n_features", "buckets"])

    return src.mapInArrow(run, f"id {kind}, n_words long, n_features long, buckets binary")


_MADE: dict = {}


def _features(shared) -> Features:
    """One table of features per worker process and broadcast."""
    if shared.value[0] not in _MADE:
        _MADE.clear()
        _MADE[shared.value[0]] = Features(*shared.value[1:])
    return _MADE[shared.value[0]]


def totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket, counted in the tasks."""
    width = "<u4" if buckets > 1 << 16 else "<u2"

    def run(batches):
        count = np.zeros(buckets, "i8")
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                count += np.bincount(np.frombuffer(raw, width), minlength=buckets)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(count[at])], ["bucket", "n"])

    out = np.zeros(buckets, "i8")
    for bucket, n in rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n  # a row for each bucket at most
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of a bucket's smoothed share in the target over that in the source)."""
    n, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + n) / ((s + 1) * (all_t + n)))) for s, t in zip(source.astype("f8").tolist(), target.astype("f8").tolist())], "i8")


def gumbel(id_text: str, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{id_text}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def numbered(df: DataFrame, *order) -> DataFrame:
    """Rows numbered from 1 in this order (column ``rank``): sorted by
    ranges, each range's rows counted, no task sees more than its range."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the number of the task and of the row within it, in one number
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "resampling-ranked")
    task = F.shiftright("_place", 33)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    # a row for each task
    before = sizes.select("_task", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_task", task).join(before, "_task").withColumn("rank", place + F.col("_before") + 1).drop("_place", "_task", "_before")


def last_drawn(scores: DataFrame, drawn: int, step: int = 256) -> int | None:
    """The score of number ``drawn`` from the top (None if none is drawn).
    Scores are whole numbers in a range that the formula bounds, so counts of
    steps, then of the scores of one step, are few whatever the rows."""
    if not drawn:
        return None
    above, low = 0, None
    for width in (step, 1):
        by = F.floor(F.col("score") / width)
        of = scores if low is None else scores.where(F.floor(F.col("score") / step) == low)
        for value, n in sorted(of.groupBy(by.alias("by")).agg(F.count("*")).collect(), reverse=True):
            low = value
            if above + n >= drawn:
                break
            above += n
    return low


def resample(df: DataFrame, target: DataFrame, percent: int = 10, max_words: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", head_words: int = 50_000) -> DataFrame:
    """(id, n_features, weight, score, rank), one row per row of ``df``:
    ``rank`` counts the drawn ones, the best score first; the rest have none."""
    spark = df.sparkSession
    found = frequent(df, text_col, max_words, head_words)
    head = [w for w, after in found if after is None]
    known = set(head)
    pairs = [p for p in found if p[1] is not None and known.issuperset(p)]
    # at most ``head_words`` words and pairs
    shared = spark.sparkContext.broadcast((scratch_path(spark, "head"), head, pairs, max_words, buckets))
    path = scratch_path(spark, "resampling-features")
    feature_rows(df, shared, id_col, text_col).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    gain = gains(totals(rows, buckets), totals(feature_rows(target, shared, target_text_col, target_text_col), buckets))
    gain = spark.sparkContext.broadcast(gain)
    width = "<u4" if buckets > 1 << 16 else "<u2"
    kind = rows.schema["id"].dataType.simpleString()

    def score(batches):
        each = gain.value
        for batch in batches:
            for part in slices(batch):
                n = part.column(3).to_numpy()
                weight = np.array([int(each[np.frombuffer(raw, width)].sum()) // k if k else 0 for raw, k in zip(part.column(4).to_pylist(), n.tolist())], "i8")
                noise = np.array([gumbel(x or "", seed) for x in part.column(1).to_pylist()], "i8")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(weight), pa.array(weight + noise)], ["id", "n_words", "n_features", "weight", "score"])

    asked = rows.select("id", F.col("id").cast("string").alias("id_text"), "n_words", "n_features", "buckets")
    scored = materialize(asked.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long, score long"), "resampling-scores")
    may = F.col("n_words") >= least_words
    drawn = scored.where(may).count() * percent // 100
    least = last_drawn(scored.where(may).select("score"), drawn)
    near = may & (F.col("score") >= F.lit(least)) if least is not None else F.lit(False)
    out = ["id", "n_features", "weight", "score", "rank"]
    first = numbered(scored.where(near), F.desc("score"), F.asc_nulls_first("id"), F.desc("weight"), "n_features") if least is not None else scored.where(near).withColumn("rank", F.lit(None).cast("long"))
    first = first.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(out)
    rest = scored.where(~near).withColumn("rank", F.lit(None).cast("long")).select(out)
    return first.unionAll(rest).select(F.col("id").alias(id_col), *out[1:])
