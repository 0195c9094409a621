"""Packing along a space-filling curve.

Each document is encoded, its hashed token vector is projected to a few
dimensions, and the point's place on a Hilbert curve is its key. Documents
are range-sorted by that key, so documents alike in wording lie side by side,
and are laid end to end into sequences of ``length`` tokens, cut freely.

Scale: texts are read and encoded once, and the ids written in two or four
bytes each to the shared folder (the range sort samples its input, which
would encode everything again). The range sort's second key is the id, so a
large group of copies is split over tasks. Every task packs its own range as a
stream and leaves at most one sequence unfilled; sequence ids carry the
task's number.

Defined results: a null or empty text is its end id alone; a null id is
packed like any other; each of several rows with one id is packed by itself;
an empty table gives an empty table. Only the named columns are read, so
extra columns of any name are ignored. Texts are packed whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.bpe import coder, read_spec
from lakeops.llm.common import id_text, slices
from lakeops.session import scratch_path

#: Sequence ids: the task's number, then the sequence within it.
TASK_BITS = 40
#: Bytes of ids that one range of the curve holds.
RANGE_BYTES = 16 << 20


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with whole coordinates
    under 2^bits. Skilling's transform: coordinates to the curve's transposed
    index by inverting and exchanging low bits from the top bit down, a Gray
    code, then interleaving."""
    x = points.astype("u8").T.copy()
    dims = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        gray ^= np.where(x[-1] & q, q - one, np.uint64(0))
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << one | (x[i] >> np.uint64(b) & one)
    return key.astype("i8")


#: Places of the hashed document vector.
PLACES = 256


@lru_cache(maxsize=2)
def _hashing(vocabulary: int, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Once per worker: a token's place in the vector and its sign, by a
    multiplicative hash, and the fixed matrix that projects the vector."""
    h = np.arange(vocabulary, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)
    place, sign = (h >> np.uint64(56)).astype("i8") % PLACES, 1.0 - 2.0 * ((h >> np.uint64(55)) & np.uint64(1)).astype("f8")
    return place, sign, np.random.default_rng(11).standard_normal((PLACES, dims))


def curve_places(ids: list[np.ndarray], vocabulary: int, dims: int = 4, bits: int = 15) -> np.ndarray:
    """Key of each document's ids: its mean hashed vector (signed counts of
    the tokens in ``PLACES`` places), projected to ``dims`` dimensions and
    squashed to a grid of 2^bits steps a side."""
    place, sign, matrix = _hashing(vocabulary, dims)
    size = np.array([len(x) for x in ids], "i8")
    flat = np.concatenate(ids) if len(ids) else np.empty(0, "<u4")
    at = np.repeat(np.arange(len(ids)) * PLACES, size) + place[flat]
    vectors = np.bincount(at, weights=sign[flat], minlength=len(ids) * PLACES).reshape(-1, PLACES)
    points = vectors @ matrix / np.maximum(size, 1)[:, None]
    grid = ((np.tanh(3 * points) + 1) / 2 * ((1 << bits) - 1)).astype("u8")
    return hilbert_key(grid, bits)


def pack(df: DataFrame, tokenizer_path: str, end_id: int, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (id, start, length, ids binary of little-endian
    uint32, doc_tokens, sequence_id, offset)."""
    spark = df.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    src = id_text(df, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    vocabulary = len(coder(spec.value).tokens)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def encode(batches):
        bpe = coder(spec.value)
        for batch in batches:
            for part in slices(batch):
                ids = [np.frombuffer(b, "<u4") for b in bpe.encode_many(part.column(1).to_pylist())]
                keys = curve_places(ids, vocabulary)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())], ["id", "place", "ids"])

    path = scratch_path(spark, "packing-ids")
    src.mapInArrow(encode, f"id {kind}, place long, ids binary").write.option("compression", "zstd").parquet(path)
    encoded = spark.read.parquet(path)
    # as many ranges as the ids' bytes ask for
    size = encoded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    ordered = encoded.repartitionByRange(1 + size // RANGE_BYTES, "place", "id").sortWithinPartitions("place", "id").select("id", "ids")
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def lay(batches):
        sequence, at = TaskContext.get().partitionId() << TASK_BITS, 0
        for batch in batches:
            for part in slices(batch):
                cols: list[list] = [[] for _ in names]
                for k, raw in enumerate(part.column(1).to_pylist()):
                    ids = np.append(np.frombuffer(raw, width), end_id).astype("<u4").tobytes()
                    total, start = len(ids) // 4, 0
                    while start < total:
                        take = min(total - start, length - at)
                        for col, value in zip(cols, (k, start, take, ids[4 * start : 4 * (start + take)], total, sequence, at)):
                            col.append(value)
                        start, at = start + take, at + take
                        if at == length:
                            sequence, at = sequence + 1, 0
                rows = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), *(pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names[1:], cols[1:]))], names)

    out = ordered.mapInArrow(lay, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.select(F.col("id").alias(id_col), *names[1:])
