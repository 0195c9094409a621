"""A small filter of the keys of each partition of a stored table (K3).

A merge has to find the partitions that hold a key whose row moves elsewhere,
and without help it reads every key of the table. Beside the table lies a
Bloom filter per partition, a few bits a key: ``buckets`` bitmaps of 32,768
bits, a key setting ``PROBES`` bits of one of them. ``candidates`` names the
partitions that may hold one of the given keys; no partition that does is left
out, and a wrong candidate only costs its reading.

The filter is written before the rows it speaks of and covers what a partition
held and will hold, so whatever breaks off in between, it lacks no key. It is
made and asked with built-in bitmap functions; a key meets one bitmap of each
partition. Keys with a null part are in no filter: they match nothing in a merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources import fs

PART = "_part"
#: Bits of a bitmap (what Spark's bitmap functions use), bits a key sets, bits provided for a key.
BITMAP, PROBES, BITS_A_KEY = 32_768, 4, 12


def filter_path(path: str) -> str:
    return f"{path.rstrip('/')}__keys"


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *keys)


def _bucket(keys: Sequence[str], buckets: Column | int) -> Column:
    return F.pmod(_hash(keys, 3), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def key_filters(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(keys, _part) -> (_part, bucket, buckets, bits), the bits combined before the shuffle."""
    each = rows.dropna(subset=list(keys)).select(PART, _bucket(keys, buckets).alias("bucket"), F.explode(_places(keys)).alias("place"))
    return each.groupBy(PART, "bucket").agg(F.bitmap_construct_agg("place").alias("bits")).withColumn("buckets", F.lit(buckets))


def _places(keys: Sequence[str]) -> Column:
    """Places of a key's bits; 31-bit halves of one hash keep the sums from overflowing."""
    h = _hash(keys, 1)
    first, step = F.shiftrightunsigned(h, 33), h.bitwiseAND(F.lit((1 << 31) - 1)).bitwiseOR(F.lit(1))
    return F.array(*(F.pmod(first + F.lit(i) * step, F.lit(BITMAP)) for i in range(PROBES)))


def write_filters(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Replace the filters of the partitions that ``rows`` (keys, _part) has
    rows of; a new filter is sized by its largest partition."""
    at = filter_path(path)
    known = _stored(spark, path)
    buckets = known.agg(F.max("buckets")).first()[0] if known is not None else None
    if buckets is None:
        most = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        buckets = max(1, -(-most * BITS_A_KEY // BITMAP))
    (key_filters(rows, keys, buckets).repartition(PART).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(at))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    at = filter_path(path)
    if not fs.exists(spark, at):
        return None
    return spark.read.schema(f"bucket int, bits binary, buckets int, {PART} string").parquet(at)


def candidates(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> list[str] | None:
    """Names of the partitions that may hold a key of ``source``; None if the
    table has no filter."""
    filters = _stored(spark, path)
    if filters is None:
        return None
    buckets = filters.agg(F.max("buckets")).first()[0]
    if buckets is None:
        return []
    asked = source.dropna(subset=list(keys)).select(_bucket(keys, buckets).alias("bucket"), _places(keys).alias("places")).distinct()

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1

    hit = asked.join(filters, "bucket").where(reduce(and_, (is_set(F.col("places")[i]) for i in range(PROBES))))
    # names of partitions only
    return sorted(r[0] for r in hit.select(PART).distinct().collect())
