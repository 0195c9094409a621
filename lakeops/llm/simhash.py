"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by a space (fewer words: the whole sequence); a bit
is 1 if it is set in over half the shingles' XXH64 (seed 42), repeats
counted. Texts without a word, and null ones, have fingerprint zero.

Search: every bit position gets a random non-zero vector of r + 1 bits; for
each of the 2^(r+1) - 1 non-zero vectors v there is a table that keys
fingerprints by the bits whose vector is not orthogonal to v (odd parity).
Any r differing bits leave a v orthogonal to all of their vectors, which keeps
none of them, so two fingerprints within r bits agree in the key of at least
one table: no pair is missed.

Scale: only distinct fingerprints are searched, so copies are one row. Rows
of a table's bucket meet in one task, sorted; only the links of a spanning
forest leave it, never all pairs. A bucket of more than ``crowd``
fingerprints isn't gathered: its members go through an exact way of linear
size instead. Two fingerprints are within 2 s bits just when some midpoint is
within s bits of both, and a midpoint has few distinct fingerprints that
near, whatever the data.

Defined results: null texts and texts without words are linked with each
other and with fingerprints of few bits; a null id is kept with its
fingerprint and the smallest non-null id of its component; repeated rows
each get a row; an empty table gives an empty table. Only the named columns
are read, so extra columns of any name are ignored. Texts are taken whole.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeops.llm.common import gathered, id_text, slices
from lakeops.llm.components import connected_components
from lakeops.session import materialize

WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The text's 64 bits as a signed integer."""
    words = WORDS(text.encode().translate(LOWER)) if text else ()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), "u8", n)
    set_ = np.zeros(64, "i8")
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        set_ += bits.sum(0, dtype="i8")
    return int(np.packbits(2 * set_ > n, bitorder="little").view("i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp long, text_hash long), one row per input row."""
    src = id_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [fingerprint(t, shingle) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64()), part.column(2)], ["id", "fp", "text_hash"])

    return src.mapInArrow(run, f"id {kind}, fp long, text_hash long")


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The bit masks of the tables, as signed integers. The vectors are dealt
    evenly over the positions, so every mask keeps 32 bits or so."""
    size = 1 << (radius + 1)
    rng = np.random.default_rng(seed)
    vectors = np.concatenate([rng.permutation(np.arange(1, size)) for _ in range(-(-64 // (size - 1)))])[:64]
    masks = []
    for v in range(1, size):
        keep = np.array([bin(int(x) & v).count("1") % 2 == 1 for x in vectors])
        masks.append(int(np.packbits(keep, bitorder="little").view("i8")[0]))
    return masks


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within the radius."""
    rest, links = fps, []
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count((rest ^ todo[-1]).view("u8")) <= radius
            at = todo.pop()
            if near.any():
                links += [(int(at), int(x)) for x in rest[near]]
                todo += rest[near].tolist()
                rest = rest[~near]
    return links


_LINK = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """(key, fp) in runs of a key within a partition -> links."""

    def run(batches):
        kept_key, kept = None, []

        def close():
            return _forest(np.unique(np.concatenate(kept)), radius) if kept else []

        for batch in gathered(batches):
            key, fp = (c.to_numpy() for c in batch.columns)
            if not len(key):
                continue
            cuts = np.flatnonzero(np.diff(key)) + 1
            links = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if key[a] != kept_key:
                    links += close()
                    kept_key, kept = key[a], []
                kept.append(fp[a:b])
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        last = close()
        a, b = zip(*last) if last else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.mapInArrow(run, _LINK)


def _midpoint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links of the fingerprints (fp) within the radius of each other: those
    that reach the same midpoint by half the radius (for an odd radius, one
    of the two by one bit more)."""
    near = radius // 2
    flips = [sum(1 << b for b in bits) for n in range(near + 1) for bits in combinations(range(64), n)]
    flips = np.array(flips, "u8").view("i8")
    extra = np.array([0] if radius % 2 == 0 else [0, *(1 << b for b in range(64))], "u8").view("i8")

    def run(batches):
        for batch in batches:
            for fp in batch.column(0).to_numpy():
                for e in extra:
                    yield pa.RecordBatch.from_arrays([pa.array(flips ^ fp ^ e), pa.array(np.full(len(flips), fp))], ["mid", "fp"])

    mids = fps.mapInArrow(run, "mid long, fp long")
    low = mids.groupBy("mid").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high").select("mid", "low")
    # an odd radius links through one step more than it may: checked here
    return mids.join(low, "mid").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("low"))) <= radius).select(F.col("fp").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def near_links(fps: DataFrame, radius: int = 4, crowd: int = 16_384) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct
    fingerprints (column fp) at most ``radius`` (even) bits apart."""
    if radius % 2:
        raise ValueError("an even radius is needed")
    masks = covering_masks(radius)
    keyed = fps.select("fp", F.explode(F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)))).alias("key"))
    keyed = materialize(keyed.select("key", "fp"), "simhash-keys")
    count = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(keyed.join(count, "key"), "simhash-buckets")
    small = met.where(F.col("n") <= crowd).select("key", "fp").repartition("key").sortWithinPartitions("key")
    links = _bucket_links(small, radius)
    crowded = met.where(F.col("n") > crowd).select("fp").distinct()
    return links.union(_midpoint_links(crowded, radius))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, crowd: int = 16_384) -> DataFrame:
    """(id, fp, component_id, root, text_hash): ``component_id`` is the
    smallest id that a chain of links reaches; ``root``, a fingerprint, names
    the component (two may have one smallest id, where ids repeat)."""
    rows = materialize(fingerprints(df, id_col, text_col, shingle), "simhash-fps")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(near_links(distinct.select("fp"), radius, crowd))
    found = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    found = materialize(found, "simhash-roots")
    least = found.groupBy("root").agg(F.min("low").alias("component_id"))
    of = found.join(least, "root").select("fp", "component_id", "root")
    return rows.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "root", "text_hash")


def keep_one(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component in ``found``, all columns as they are: the
    smallest id's (a null id counts as the greatest); of several texts under
    that id the one whose hash is smallest, of equal rows one."""
    best = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash")).alias("best"))
    best = best.select(F.col("best.id").alias("_best_id"), F.col("best.text_hash").alias("_best_hash"))
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash"))
    rows = rows.join(best, F.col("_id").eqNullSafe(F.col("_best_id")) & (F.col("_hash") == F.col("_best_hash")), "left_semi")
    same = Window.partitionBy("_id", "_hash").orderBy(F.xxhash64("_row"))
    return rows.withColumn("_n", F.row_number().over(same)).where("_n = 1").select("_row.*")
