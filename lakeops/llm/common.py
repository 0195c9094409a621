"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of one Arrow slice handled at a time inside a task.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: rows are whole texts, some very long, and a batch
#: is held by the executor and by its Python worker.
BATCH_SETTING, BATCH_ROWS, SPARK_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000, "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    return public_tokenizers.path(name)


def small_batches(spark: SparkSession) -> None:
    """Ask the session for small Arrow batches, unless it has a setting of its own."""
    if spark.conf.get(BATCH_SETTING) == SPARK_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own, so
    that extra columns can't clash."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def slices(batch, size: int = SLICE_BYTES):
    """A record batch in slices of about ``size`` bytes (a row is never cut)."""
    rows = batch.num_rows
    if rows:
        step = max(1, int(rows * size / max(batch.nbytes, 1)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def held_out(id_col) -> F.Column:
    """True for the third of the ids that models never learn from: the
    remainder 1 of the id text's CRC32 (a null id counts as held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def share_of(id_col: str, share) -> F.Column:
    """True for about that share of the ids, by hash: the same at every run."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000


def gathered(batches, rows: int = 50_000):
    """Batches of short rows put together, for steps that work by column."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def filter_rows(df: DataFrame, text_col: str, keeps) -> DataFrame:
    """The rows whose text passes, all columns as they are. ``keeps`` makes,
    once a task, a function from a list of texts to a list of booleans."""
    import pyarrow as pa

    at = df.columns.index(text_col)
    small_batches(df.sparkSession)

    def run(batches):
        keep = keeps()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


class KeyTable:
    """64-bit keys (not negative) -> 32-bit values in numpy arrays (open
    addressing), for looking up whole columns at once."""

    def __init__(self, items: dict[int, int], none: int):
        bits = max(4, int(len(items) * 4).bit_length())
        self.shift, mask, self.none = 64 - bits, (1 << bits) - 1, np.int32(none)
        keys, values, self.probes = np.full(1 << bits, -1, "i8"), np.full(1 << bits, none, "i4"), 1
        for key, value in items.items():
            at, step = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> self.shift, 1
            while keys[at] >= 0:
                at, step = (at + 1) & mask, step + 1
            keys[at], values[at], self.probes = key, value, max(self.probes, step)
        self.keys, self.values = np.append(keys, keys[: self.probes]), np.append(values, values[: self.probes])

    def __call__(self, key: np.ndarray) -> np.ndarray:
        at = ((key.astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype("i8")
        there = self.keys[at]
        out = np.where(there == key, self.values[at], self.none)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        at, key, flat = at.ravel(), key.ravel(), out.ravel()
        for step in range(1, self.probes):
            if not len(open_):
                break
            there, want = self.keys[at[open_] + step], key[open_]
            hit = there == want
            flat[open_[hit]] = self.values[at[open_[hit]] + step]
            open_ = open_[~hit & (there >= 0)]
        return out
