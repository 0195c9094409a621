"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: the sign bits of a learned rotation of their
principal components (iterative quantisation). Inner products on vectors of
unlike norms are brought to angles first, by one more coordinate that
fills every vector up to the largest norm. A code is cut into substrings and
each substring is indexed. If two codes differ in at most r = m q + a bits,
then one of the first a + 1 substrings differs in at most q bits, or one of
the others in at most q - 1: probing those lists retrieves every code within
the radius. The retrieved vectors are reranked by their exact inner products.

``fit_codes`` learns rotation and radius on a bounded sample of about
``sample`` vectors: the radius is the smallest one that holds ``target`` of the
neighbours that the sample stands for. Every vector is indexed. Queries that
find fewer than k within the radius, over all shards, are asked again with a
wider one, up to all bits, so that fewer than k are returned only if there are
fewer candidates.

Scale: vectors are dealt into shards of about ``shard_rows`` by hash, queries
into blocks of about ``block_rows``; each pair of shard and block is one
task's work on a bounded table, and a task returns the k best of its shard per
query. Nothing is gathered whole.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those whose length isn't the most frequent
one; null ids take no part; rows with a query's id are not its candidates;
of several query rows with one id the smallest vector asks; equal scores go
to the smaller id; an empty table gives an empty table. Only the named
columns are read, so extra columns of any name are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import share_of
from lakeops.session import materialize

_ONES = np.array([bin(x).count("1") for x in range(256)], "u1")


def _rows(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(-1, dims)


@dataclass
class Codes:
    dims: int
    norm: float            # the largest, of all vectors
    mean: np.ndarray
    rotation: np.ndarray   # dims + 1 x bits
    radius: int

    def _bits(self, filled: np.ndarray) -> np.ndarray:
        return np.packbits((filled - self.mean) @ self.rotation > 0, axis=1, bitorder="little")

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        """Codes as bytes; a byte is a substring."""
        x = x / self.norm
        return self._bits(np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))]))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return self._bits(np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))]))


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection: principal components, rotated so that the signs
    lose least."""
    mean = x.mean(0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:bits].T
    y = (x - mean) @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((y.shape[1],) * 2))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    return mean, axes @ turn


def fit_codes(vectors: DataFrame, k: int, sample: int = 6000, target: float = 0.97, max_bits: int = 64) -> Codes | None:
    """``vectors``: (id, vec) as ``usable_vectors`` returns them."""
    about = vectors.agg(F.count("*").alias("n"), F.max(F.sqrt(_sum_of_squares("vec"))).alias("norm"), F.max(F.size("vec")).alias("dims")).first()
    if not about.n:
        return None
    share = min(1.0, sample / about.n)
    x = np.array([r.vec for r in vectors.where(share_of("id", share)).orderBy("id").limit(2 * sample).collect()], "f8").reshape(-1, about.dims)
    if len(x) < 2:
        x = np.array([r.vec for r in vectors.orderBy("id").limit(2 * k).collect()], "f8")
    filled = np.column_stack([x / about.norm, np.sqrt(np.maximum(0, 1 - (x * x).sum(1) / about.norm**2))])
    bits = min(max_bits, about.dims, len(x))
    mean, rotation = learn_rotation(filled, bits)
    codes = Codes(about.dims, about.norm, mean, rotation, bits)
    # neighbours in the sample that stand for the k nearest among all
    asked = x[:: max(1, len(x) // 300)]
    near = min(len(x) - 1, max(2, math.ceil(k * len(x) / about.n)))
    if near > 0:
        scores = asked @ x.T
        scores[np.arange(len(asked)), np.arange(0, len(x), max(1, len(x) // 300))] = -np.inf
        best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
        apart = _ONES[codes.of_queries(asked)[:, None, :] ^ codes.of_vectors(x)[best]].sum(2)
        codes.radius = int(np.quantile(apart, target, method="higher"))
    return codes


def _sum_of_squares(col: str) -> F.Column:
    return F.aggregate(col, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the rows that take part."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where("id is not null and vec is not null and size(vec) > 0")
    rows = rows.where(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0))
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (common[0].n if common else 0))


class SubstringIndex:
    """Lists of rows by the value of each byte of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[r, j], np.arange(257)) for j, r in enumerate(self.rows)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        m = len(code)
        whole, rest = divmod(radius, m)
        met = np.zeros(len(self.codes), bool)
        for j in range(m):
            reach = whole if j <= rest else whole - 1
            for value in np.flatnonzero(_ONES[np.arange(256) ^ code[j]] <= reach) if reach >= 0 else ():
                met[self.rows[j][self.starts[j][value] : self.starts[j][value + 1]]] = True
        rows = np.flatnonzero(met)
        return rows[_ONES[self.codes[rows] ^ code].sum(1) <= radius]


def search(df: DataFrame, queries: F.Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = 16_384, block_rows: int = 8192, sample: int = 6000, target: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row
    that ``queries`` (a condition on the id, as column ``id``) picks."""
    spark = df.sparkSession
    vectors = materialize(usable_vectors(df, id_col, vec_col), "vectors")
    kind = vectors.schema["id"].dataType.simpleString()
    asked = vectors.where(queries).groupBy("id").agg(F.min("vec").alias("vec"), F.count("*").alias("own"))
    codes = fit_codes(vectors, k, sample, target)
    schema = f"query_id {kind}, vec_id {kind}, score double"
    if codes is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    sent = spark.sparkContext.broadcast(codes)  # a rotation: dims x bits
    deal = lambda df, name, parts: df.withColumn(name, F.pmod(F.xxhash64("id", "vec", F.lit(name)), F.lit(parts)))
    spread = lambda df, name, parts: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))

    def best(vecs: pa.Table, asks: pa.Table, radius: int) -> pa.Table:
        codes = sent.value
        ids, x = vecs.column("id").to_numpy(), _rows(vecs.column("vec"), codes.dims)
        qids, q = asks.column("id").to_numpy(), _rows(asks.column("vec"), codes.dims)
        found: list[tuple] = []
        if len(ids) and len(qids):
            index, probes = SubstringIndex(codes.of_vectors(x)), codes.of_queries(q)
            for qid, vec, code in zip(qids, q, probes):
                rows = index.within(code, radius)
                rows = rows[ids[rows] != qid]
                rough = x[rows] @ vec
                if len(rows) > k:
                    rows = rows[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9 * codes.norm * np.linalg.norm(vec)]
                score = (x[rows] * vec).sum(1)  # summed alike for every row
                top = np.lexsort((ids[rows], -score))[:k]
                found.append((np.full(len(top), qid), ids[rows[top]], score[top]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table([pa.array(cols[0], vecs.schema.field("id").type), pa.array(cols[1], vecs.schema.field("id").type), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

    def probe(asked: DataFrame, radius: int) -> DataFrame:
        blocks = max(1, -(-asked.count() // block_rows))
        left = spread(deal(vectors, "shard", shards), "block", blocks)
        right = spread(deal(asked.select("id", "vec"), "block", blocks), "shard", shards)
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(lambda vecs, asks: best(vecs, asks, radius), schema)

    # queries that found too few are asked again, with twice the radius: a handful of rounds
    radius, bits = codes.radius, codes.rotation.shape[1]
    asked, whole = materialize(asked, "asked"), []
    while True:
        found = materialize(probe(asked, radius), "nearest")
        if radius >= bits:
            break
        got = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("got"))
        few = F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.lit(n) - F.col("own"))
        short = materialize(asked.join(got, "id", "left").where(few).drop("got"), "asked-again")
        if short.isEmpty():
            break
        whole.append(found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti"))
        asked, radius = short, min(bits, 2 * radius + 1)
    for part in whole:
        found = found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
