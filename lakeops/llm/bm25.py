"""Exact top-k text search: an inverted index with block-max WAND.

``build_index`` cuts the documents into shards as they are read and writes, per
shard, each word's postings (document number and frequency) in blocks of
``BLOCK`` with the block's highest frequency and shortest document, and one
row with the shard's ids and lengths. ``search`` gathers the global statistics
(documents, mean length, document frequencies) from the index, so that each
shard scores as one large index would, runs block-max WAND in every shard
for its k best, and merges those exactly. Queries are split into words in the tasks and
dealt into blocks; the driver sees two totals.

Pruning: words are kept in the order of their current document; the pivot is
the first document that the words' highest scores could lift over the k-th
best so far; if the blocks around the pivot can't, everything up to the end of
the nearest block is skipped.

Score: BM25 with idf = ln(1 + (N - n + 0.5) / (n + 0.5)); a word that a query
repeats counts each time. Equal scores go to the smaller id.

Defined results: null and empty texts are documents without words and are
never found; a query without words finds nothing; null ids take no part;
several rows with one id are documents of their own, and of several query
rows with one id each asks (ranks are per id and text); an empty table
gives an empty table. Only the named columns are read, so extra columns of any
name are ignored. Texts are indexed whole.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import id_text, slices
from lakeops.session import materialize

WORDS = regex.compile(r"[\p{L}\p{N}]+").findall
K1, B, BLOCK = 1.2, 0.75, 64
#: A shard is closed at so many documents, or bytes of text.
SHARD_DOCS, SHARD_BYTES = 16_384, 64 << 20
#: The word of a shard's row of ids and lengths.
ABOUT = 0


def word_key(word: str) -> int:
    """64 bits for a word; never ``ABOUT``."""
    return xxhash.xxh64_intdigest(word.encode()) - (1 << 63) or 1


def _shard_rows(shard: int, ids: list, texts: list[dict], lengths: list[int], id_type) -> pa.RecordBatch:
    order = sorted(range(len(ids)), key=lambda i: (ids[i], lengths[i]))  # equal scores: the smaller id comes first
    size = np.array([len(texts[i]) for i in order])
    words = np.fromiter((w for i in order for w in texts[i]), "i8", int(size.sum()))
    tf = np.fromiter((n for i in order for n in texts[i].values()), "i4", len(words))
    doc = np.repeat(np.arange(len(order), dtype="i4"), size)
    by = np.argsort(words, kind="stable")
    words, tf, doc = words[by], tf[by], doc[by]
    first = np.flatnonzero(np.diff(words, prepend=words[0] - 1)) if len(words) else np.empty(0, "i8")
    ends = np.append(first[1:], len(words)).astype("i4") if len(words) else np.empty(0, "i4")
    starts = np.concatenate([[0], ends]).astype("i4")
    lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(x)) for x in (doc, tf)]
    n = len(first)
    none_ids = pa.array([None] * n, pa.list_(id_type))
    about = [pa.array([shard], pa.int64()), pa.array([ABOUT], pa.int64()), pa.array([[]], pa.list_(pa.int32())), pa.array([[lengths[i] for i in order]], pa.list_(pa.int32())), pa.array([[ids[i] for i in order]], pa.list_(id_type))]
    rows = [pa.array(np.full(n, shard)), pa.array(words[first]), *lists, none_ids]
    names = ["shard", "word", "docs", "counts", "ids"]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(x, names) for x in (about, rows)]).combine_chunks()


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, word, docs, counts, ids); of a shard's row ``ABOUT`` the counts
    are the documents' lengths."""
    src = id_text(df, id_col, text_col).where("id is not null")
    kind = src.schema[0].dataType.simpleString()

    def run(batches):
        task, made, memo = TaskContext.get().partitionId(), 0, {}
        ids, texts, lengths, held = [], [], [], 0
        id_type = None

        def close():
            nonlocal made, ids, texts, lengths, held
            found = _shard_rows(task << 32 | made, ids, texts, lengths, id_type)
            made, ids, texts, lengths, held = made + 1, [], [], [], 0
            return found.to_batches(max_chunksize=50_000)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in slices(batch):
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = WORDS(text.lower()) if text else []
                    if len(memo) > 400_000:
                        memo.clear()
                    for w in words:
                        if w not in memo:
                            memo[w] = word_key(w)
                    ids.append(i)
                    lengths.append(len(words))
                    texts.append(Counter([memo[w] for w in words]))
                    held += len(text or "")
                    if len(ids) >= SHARD_DOCS or held >= SHARD_BYTES:
                        yield from close()
        if ids:
            yield from close()

    return src.mapInArrow(run, f"shard long, word long, docs array<int>, counts array<int>, ids array<{kind}>")


class _Postings:
    """A word's list in a shard, with a place in it."""

    __slots__ = ("docs", "scores", "last", "block_most", "most", "at", "doc", "end")

    def __init__(self, docs: np.ndarray, counts: np.ndarray, lengths: np.ndarray, weight: float, mean: float):
        norm = K1 * (1 - B + B * lengths[docs] / mean)
        scores = weight * (counts * (K1 + 1) / (counts + norm))
        cuts = np.arange(0, len(docs), BLOCK)
        # a bound from the highest frequency and the shortest document of a block
        tf, short = np.maximum.reduceat(counts, cuts), np.minimum.reduceat(norm, cuts)
        self.block_most = (weight * (tf * (K1 + 1) / (tf + short))).tolist()
        self.last = docs[np.append(cuts[1:], len(docs)) - 1].tolist()
        self.docs, self.scores, self.most = docs.tolist(), scores.tolist(), max(self.block_most)
        self.at, self.doc, self.end = 0, self.docs[0], len(self.docs)

    def seek(self, doc: int) -> None:
        self.at = bisect_left(self.docs, doc, self.at)
        self.doc = self.docs[self.at] if self.at < self.end else NEVER

    def block(self, doc: int) -> int:
        return bisect_left(self.last, doc, self.at // BLOCK)


NEVER = 1 << 60


def block_max_wand(lists: list[_Postings], k: int) -> list[tuple[float, int]]:
    """The k best (score, document), ties to the smaller document."""
    best: list[tuple[float, int]] = []  # a heap of (score, -document)
    floor = 0.0
    every, live = list(lists), list(lists)
    while True:
        live = [p for p in live if p.doc != NEVER]
        live.sort(key=lambda p: p.doc)
        reach, pivot = 0.0, None
        for i, p in enumerate(live):
            reach += p.most
            if reach * (1 + 1e-9) > floor:
                pivot = i
                break
        if pivot is None:
            break
        doc = live[pivot].doc
        while pivot + 1 < len(live) and live[pivot + 1].doc == doc:
            pivot += 1
        blocks = [(p, j) for p in live[: pivot + 1] if (j := p.block(doc)) < len(p.last)]
        if sum(p.block_most[j] for p, j in blocks) * (1 + 1e-9) > floor:
            if live[0].doc == doc:
                score = 0.0
                for p in every:  # in the query's order, so that sums don't depend on the shard
                    if p.doc == doc:
                        score += p.scores[p.at]
                if len(best) < k:
                    heapq.heappush(best, (score, -doc))
                elif score > best[0][0]:
                    heapq.heapreplace(best, (score, -doc))
                if len(best) == k:
                    floor = best[0][0]
                for p in live[: pivot + 1]:
                    p.seek(doc + 1)
            else:
                for p in live[:pivot]:
                    if p.doc < doc:
                        p.seek(doc)
        else:
            to = min([p.last[j] + 1 for p, j in blocks] + [live[pivot + 1].doc if pivot + 1 < len(live) else NEVER])
            for p in live[: pivot + 1]:
                if p.doc < to:
                    p.seek(to)
    return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def query_terms(queries: DataFrame, query_id: str, query_text: str) -> DataFrame:
    """(id, text_hash, nth, word, times): a row for each different word of a query."""
    asked = id_text(queries, query_id, query_text).where("id is not null and text is not null")
    kind = asked.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                row, cols = [], ([], [], [], [])
                for k, text in enumerate(part.column(1).to_pylist()):
                    text_hash = xxhash.xxh64_intdigest(text.encode()) - (1 << 63)
                    for nth, (word, times) in enumerate(Counter(map(word_key, WORDS(text.lower()))).items()):
                        row.append(k)
                        for col, value in zip(cols, (text_hash, nth, word, times)):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32())))], ["id", "text_hash", "nth", "word", "times"])

    return asked.mapInArrow(run, f"id {kind}, text_hash long, nth int, word long, times int")


def search(index: DataFrame, queries: DataFrame, k: int = 20, query_id: str = "item_id", query_text: str = "text", block_terms: int = 20_000) -> DataFrame:
    """(query_id, rank, doc_id, score). Queries are dealt into blocks of about
    ``block_terms`` words; every shard meets every block with the block's own
    lists, and all of it stays in Spark."""
    about = index.where(F.col("word") == ABOUT).agg(F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, v: s + v)).alias("length")).first()
    mean = (about.length or 0) / (about.n or 1)
    terms = materialize(query_terms(queries, query_id, query_text), "bm25-terms")
    kind_q, kind_d = terms.schema["id"].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    blocks = 1 + terms.count() // block_terms
    terms = terms.withColumn("block", F.pmod(F.xxhash64("id", "text_hash"), F.lit(blocks)))
    # only the lists of words that are asked for
    found = materialize(index.join(terms.select("word").distinct(), "word"), "bm25-lists")
    count = found.groupBy("word").agg(F.sum(F.size("docs")).alias("n"))
    weight = F.log(1 + (F.lit(about.n or 0) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    term = F.struct("id", "text_hash", "nth", "word", "times", weight.alias("weight"))
    of_block = terms.join(count, "word").groupBy("block").agg(F.collect_list(term).alias("terms"))
    lists = found.join(terms.select("word", "block").distinct(), "word")
    # the shard's ids and lengths meet the block's words, the lists come beside
    top = index.where(F.col("word") == ABOUT).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(of_block, "block")
    cols = ["shard", "block", "word", "docs", "counts", "ids"]
    rows = top.select(*cols, "terms").unionAll(lists.select(*cols, F.lit(None).cast(top.schema["terms"].dataType).alias("terms")))

    def best(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        word, out = rows.column("word").to_pylist(), []
        d_type, q_type = rows.schema.field("ids").type.value_type, rows.schema.field("terms").type.value_type.field("id").type
        if ABOUT in word:
            first = word.index(ABOUT)
            lengths, ids = np.array(rows.column("counts")[first].as_py()), rows.column("ids")[first].as_py()
            lists = {w: (rows.column("docs")[i].values.to_numpy(), rows.column("counts")[i].values.to_numpy()) for i, w in enumerate(word) if w != ABOUT}
            asked: dict = {}
            for t in sorted(rows.column("terms")[first].as_py(), key=lambda t: t["nth"]):
                if t["word"] in lists:
                    asked.setdefault((t["id"], t["text_hash"]), []).append(_Postings(*lists[t["word"]], lengths, t["weight"] * t["times"], mean))
            for (qid, text_hash), mine in asked.items():
                out += [(qid, text_hash, ids[d], s) for s, d in block_max_wand(mine, k)]
        found = list(zip(*out)) or [(), (), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(found, (q_type, pa.int64(), d_type, pa.float64()))], names=["query_id", "text_hash", "doc_id", "score"])

    out = rows.groupBy("shard", "block").applyInArrow(best, f"query_id {kind_q}, text_hash long, doc_id {kind_d}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "text_hash").orderBy(F.desc("score"), "doc_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
