"""SCD2 over a stream, late rows included.

A version row alone cannot absorb a late snapshot that splits it, so the
snapshots are kept beside the history, both in buckets of keys, and each
micro-batch (``foreachBatch``) rebuilds what it touches:

1. its rows are written to the buckets' snapshots, in a folder named by the
   stream's own id and the batch id: a replayed batch overwrites its own
   rows, a stream with a new checkpoint has another id and overwrites nothing;
2. the history of the batch's keys is rebuilt from the touched buckets'
   snapshots;
3. the history of those buckets is replaced by dynamic partition overwrite:
   previous rows of other keys, plus the rebuilt ones. Keys of a touched
   bucket that the history lacks (after a write that broke off) are rebuilt
   with them.

Buckets are those of extendible hashing (``KeyDirectory``): a bucket holds the
keys whose hash ends in its bits, and one that would hold more than
``bucket_rows`` snapshots is split in two by one more bit, its own rows only
being moved. So a bucket's size, and with it what a batch rewrites for a key,
stays the same while the table grows. A bucket that one key fills can't be
split by hash: it is split into ranges of the sequence instead, and stores
versions per range; a late row touches its own range, and reading joins the
ranges' versions up (versions are to a history what snapshots are).

The directory is published after the rows it speaks of are written, and what
it no longer names is deleted after that and never read: a batch that breaks
off in between is simply replayed. Keys are compared null-safe, so a null key
keeps its history. The result equals the batch build over all snapshots,
whatever the arrival order. Rules on the batches (``expectations``) are counted
per batch, and one that fails stops the stream before the batch is written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.expectations import Expectation
from lakeops.operators.history import scd2_history
from lakeops.session import materialize
from lakeops.sources import fs
from lakeops.streaming.expected import gate, store_counts

#: Partition columns of the stored tables: bucket, sequence range, and whose rows they are.
BUCKET, RANGE = T.StructField("_kb", T.StringType()), T.StructField("_sr", T.IntegerType())
FOLDERS = [T.StructField("_run", T.StringType()), T.StructField("_batch", T.LongType())]
AT = ["_kb", "_sr"]


class KeyDirectory:
    """Bucket label -> its sequence ranges [(lower bound as text or None,
    range id, rows)]; one range without a bound for buckets that aren't split
    by sequence. A label is ``b`` and the bits of the hashes it holds, lowest
    bit first. At most 2^max_depth labels."""

    def __init__(self, leaves: dict[str, list] | None = None, version: int = 0, next_range: int = 1, applied: dict | None = None):
        self.leaves = leaves or {"b": [[None, 0, 0]]}
        self.version, self.next_range, self.applied = version, next_range, applied or {}

    @property
    def depth(self) -> int:
        return max(len(label) for label in self.leaves) - 1

    def ranged(self) -> list[str]:
        return sorted(label for label, ranges in self.leaves.items() if len(ranges) > 1)

    def places(self) -> list[tuple[str, int]]:
        return [(label, r[1]) for label, ranges in self.leaves.items() for r in ranges]

    def rows(self, label: str, range_id: int) -> int:
        return next((r[2] for r in self.leaves.get(label, ()) if r[1] == range_id), 0)

    def label_of(self, bits: str) -> str:
        return next(f"b{bits[:n]}" for n in range(len(bits) + 1) if f"b{bits[:n]}" in self.leaves)

    def bucket(self, hashed: Column) -> Column:
        depth = self.depth
        if not depth:
            return F.lit("b")
        table = [self.label_of(f"{i:0{depth}b}"[::-1]) for i in range(1 << depth)]
        # folded to one literal array
        return F.element_at(F.split(F.lit(",".join(table)), ","), (F.pmod(hashed, F.lit(1 << depth)) + 1).cast("int"))

    def range_of(self, label: Column, sequence: Column, kind: T.DataType) -> Column:
        out = F.lit(0)
        for name, ranges in self.leaves.items():
            if len(ranges) > 1 or ranges[0][1]:
                bounds = [F.lit(r[0]).cast(kind) for r in ranges[1:]]
                at = sum((F.coalesce(b <= sequence, F.lit(False)).cast("int") for b in bounds), F.lit(0))
                out = F.when(label == name, F.element_at(F.array(*(F.lit(r[1]) for r in ranges)), at + 1)).otherwise(out)
        return out.cast("int")

    def dump(self) -> str:
        return json.dumps({"leaves": self.leaves, "version": self.version, "next_range": self.next_range, "applied": self.applied})

    def copy(self) -> "KeyDirectory":
        return KeyDirectory(**json.loads(self.dump()))


def split_bucket(bits: str, counts: list[tuple[int, int, int]], most_rows: int, max_depth: int) -> dict[str, int]:
    """Bits -> rows of the buckets that take the place of one, given (low hash
    bits, rows, rows of the greatest key) of what it holds. A bucket stays
    whole if it is small, or if one key holds most of it."""
    rows = sum(n for _, n, _ in counts)
    if rows <= most_rows or len(bits) == max_depth or len(counts) < 2 or 2 * max(k for _, _, k in counts) > rows:
        return {bits: rows}
    out: dict[str, int] = {}
    for bit in (0, 1):
        out |= split_bucket(f"{bits}{bit}", [c for c in counts if c[0] >> len(bits) & 1 == bit], most_rows, max_depth)
    return out


class StreamingSCD2:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sequence: str,
                 untracked: Sequence[str] = (), tie_break: Sequence[str] = (), bucket_rows: int = 20_000,
                 max_depth: int = 16, materialize_steps: bool = True, compact_every: int = 50,
                 expectations: Sequence[Expectation] = ()):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.sequence = list(keys), sequence
        self.untracked, self.tie_break = list(untracked), list(tie_break)
        self.bucket_rows, self.max_depth, self.compact_every = bucket_rows, max_depth, compact_every
        self.materialize_steps, self.expectations = materialize_steps, list(expectations)
        self.store, self.history_root, self.directory_root = (f"{self.root}/{n}" for n in ("snapshots", "history", "directory"))

    # -- directory ----------------------------------------------------------

    def directory(self) -> KeyDirectory:
        versions = sorted(int(n[2:]) for n in fs.list_dirs(self.spark, self.directory_root))
        for version in reversed(versions):
            text = fs.read_text(self.spark, f"{self.directory_root}/v={version}/directory.json")
            if text:
                return KeyDirectory(**json.loads(text))
        return KeyDirectory()

    def _publish(self, directory: KeyDirectory) -> None:
        directory.version += 1
        fs.write_text_once(self.spark, f"{self.directory_root}/v={directory.version}/directory.json", directory.dump())
        for name in fs.list_dirs(self.spark, self.directory_root):
            if int(name[2:]) < directory.version - 1:
                fs.delete_dir(self.spark, f"{self.directory_root}/{name}")

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def _labelled(self, df: DataFrame, directory: KeyDirectory) -> DataFrame:
        df = df.drop(*AT).withColumn("_kb", directory.bucket(self._hash()))
        return df.withColumn("_sr", directory.range_of(F.col("_kb"), F.col(self.sequence), df.schema[self.sequence].dataType))

    @staticmethod
    def _among(places) -> Column:
        """On partition columns only, so that other buckets' files are pruned."""
        return F.concat_ws("/", *AT).isin([f"{a}/{b}" for a, b in places])

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        cond = (left["_kb"] == right["_kb"]) & (left["_sr"] == right["_sr"])
        for k in self.keys:
            cond = cond & left[k].eqNullSafe(right[k])
        return cond

    # -- stored tables ------------------------------------------------------

    def _snapshots(self, schema: T.StructType, places) -> DataFrame:
        stored = T.StructType([*schema.fields, BUCKET, RANGE, *FOLDERS])
        if not fs.exists(self.spark, self.store):
            return self.spark.createDataFrame([], stored).drop("_run", "_batch")
        return self.spark.read.schema(stored).parquet(self.store).filter(self._among(places)).drop("_run", "_batch")

    def _keep(self, rows: DataFrame, run: str, batch: int) -> None:
        """Write labelled snapshots, a file for each bucket and range."""
        (rows.withColumn("_run", F.lit(run)).withColumn("_batch", F.lit(batch)).repartition(*AT)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*AT, "_run", "_batch").parquet(self.store))

    def _history(self, places) -> DataFrame | None:
        if not fs.exists(self.spark, self.history_root):
            return None
        df = self.spark.read.parquet(self.history_root)
        df = df.withColumn("_kb", F.col("_kb").cast("string")).withColumn("_sr", F.col("_sr").cast("int"))
        return df.filter(self._among(places))

    def _delete(self, places) -> None:
        for label, range_id in places:
            for root in (self.history_root, self.store):
                fs.delete_dir(self.spark, f"{root}/_kb={label}/_sr={range_id}")

    # -- a batch --------------------------------------------------------------

    def _grown(self, batch: DataFrame, old: KeyDirectory) -> tuple[KeyDirectory, set]:
        """The directory that has room for the batch, and the places whose
        rows it moves. Asks for counts per bucket and per low bits of the hash
        (2^max_depth rows at most); reads only buckets that are to be split."""
        schema = T.StructType([f for f in batch.schema.fields if f.name not in AT])
        added = {(r["_kb"], r["_sr"]): r["n"] for r in batch.groupBy(*AT).agg(F.count(F.lit(1)).alias("n")).collect()}
        new, moved = old.copy(), set()
        full = [p for p in added if old.rows(*p) + added[p] > self.bucket_rows]
        if not full:
            return new, moved
        held = self._snapshots(schema, full).unionByName(batch.filter(self._among(full)))
        by_hash = [p for p in full if len(old.leaves[p[0]]) == 1]
        if by_hash:
            low = F.pmod(self._hash(), F.lit(1 << self.max_depth)).alias("low")
            each = held.filter(self._among(by_hash)).groupBy("_kb", low, *self.keys).agg(F.count(F.lit(1)).alias("n"))
            found: dict[str, list] = {}
            for r in each.groupBy("_kb", "low").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect():
                found.setdefault(r["_kb"], []).append((r["low"], r["n"], r["most"]))
            for label, range_id in by_hash:
                parts = split_bucket(label[1:], found[label], self.bucket_rows, self.max_depth)
                if len(parts) > 1:
                    del new.leaves[label]
                    new.leaves |= {f"b{bits}": [[None, 0, 0]] for bits in parts}
                    moved.add((label, range_id))
        # what one key fills is cut by its sequence
        held = materialize(self._labelled(held, new).select(*AT, self.sequence), "scd2-ranges")
        for r in held.groupBy(*AT).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > self.bucket_rows).collect():
            ranges, at = new.leaves[r["_kb"]], next(i for i, x in enumerate(new.leaves[r["_kb"]]) if x[1] == r["_sr"])
            cuts = -(-r["n"] // self.bucket_rows)
            bounds = self._bounds(held.filter(self._among([(r["_kb"], r["_sr"])])), cuts, ranges[at][0])
            if not bounds:
                continue  # one sequence value
            if (r["_kb"], r["_sr"]) in old.places():
                moved.add((r["_kb"], r["_sr"]))
            fresh = [[b, new.next_range + i, 0] for i, b in enumerate([ranges[at][0], *bounds])]
            new.next_range += len(fresh)
            ranges[at : at + 1] = fresh
        return new, moved

    def _bounds(self, rows: DataFrame, parts: int, low: str | None) -> list[str]:
        """Lower bounds of the further ranges of about equal size, of any type."""
        spread = rows.select(F.col(self.sequence).alias("s")).where("s is not null").repartitionByRange(parts, "s")
        least = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.min("s").alias("s"))
        found = [r["s"] for r in least.orderBy("s").select(F.col("s").cast("string").alias("s")).collect()]
        return [b for b in dict.fromkeys(found[1:]) if b not in (low, found[0])]

    def process(self, batch: DataFrame, batch_id: int, run_id: str | None = None) -> dict:
        """Apply one micro-batch; ``run_id`` defaults to the stream's id, which
        a checkpoint keeps over restarts. Returns how many places (buckets,
        or ranges of one) were rewritten, and how many there are."""
        spark, schema = batch.sparkSession, batch.schema
        run_id = run_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        old = self.directory()
        # a violated rule that fails stops the batch here, before anything is written
        rows, counts = gate(self._labelled(batch, old), self.expectations, "scd2-batch")
        if self.expectations:
            store_counts(spark, f"{self.root}/expectations", run_id, batch_id, self.expectations, counts)
        new, moved = self._grown(rows, old)
        rows = self._labelled(rows, new)
        touched = {(r[0], r[1]) for r in rows.select(*AT).distinct().collect()}  # places, no keys
        if not touched:
            return {"rewritten": 0, "places": len(old.places())}
        known = set(old.places())
        if moved:
            again = self._labelled(self._snapshots(schema, moved), new)
            self._keep(again, "moved", new.version)
            touched |= {(r[0], r[1]) for r in again.select(*AT).distinct().collect()}
        self._keep(rows, run_id, batch_id)
        kept = touched & known - moved  # places whose other keys' rows stay
        snaps = self._snapshots(schema, touched)
        before = self._history(kept) if kept else None
        if before is not None:
            changed = rows.select(*self.keys, *AT).distinct()
            stored, there = snaps.select(*self.keys, *AT).distinct(), before.select(*self.keys, *AT).distinct()
            lost = stored.join(there, self._same(stored, there), "left_anti")
            changed = materialize(changed.union(lost).distinct(), "scd2-keys")
            snaps = snaps.join(changed, self._same(snaps, changed), "left_semi")
        rebuilt = scd2_history(snaps, [*self.keys, *AT], self.sequence, self.untracked, self.tie_break,
                               materialize_steps=self.materialize_steps)
        if before is not None:
            rebuilt = before.join(changed, self._same(before, changed), "left_anti").unionByName(rebuilt)
        ready = materialize(rebuilt, "scd2-history")
        (ready.repartition(*AT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*AT).parquet(self.history_root))
        if new.applied.get(run_id, -1) < batch_id:  # a replayed batch isn't counted again
            sizes = {(r["_kb"], r["_sr"]): r["n"] for r in self._snapshots(schema, touched).groupBy(*AT).agg(F.count(F.lit(1)).alias("n")).collect()}
            for label, ranges in new.leaves.items():
                for r in ranges:
                    r[2] = sizes.get((label, r[1]), r[2])
            new.applied[run_id] = batch_id
        self._publish(new)
        self._delete(moved)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact(schema)
        return {"rewritten": len(touched), "places": len(new.places())}

    def run(self, stream: DataFrame, checkpoint: str, trigger_available_now: bool = True) -> None:
        w = stream.writeStream.foreachBatch(lambda df, i: self.process(df, i) and None).option("checkpointLocation", checkpoint)
        if trigger_available_now:
            w = w.trigger(availableNow=True)
        w.start().awaitTermination()

    def compact(self, schema: T.StructType) -> None:
        """Rewrite the stored snapshots, one file for each bucket and range.
        The old files go only afterwards; snapshots that are there twice in
        between, or after a break, change no history."""
        places = self.directory().places()
        old = {p: fs.list_dirs(self.spark, f"{self.store}/_kb={p[0]}/_sr={p[1]}") for p in places}
        self._keep(self._snapshots(schema, places).distinct(), f"compact-{uuid.uuid4().hex[:12]}", 0)
        for (label, range_id), runs in old.items():
            for name in runs:
                fs.delete_dir(self.spark, f"{self.store}/_kb={label}/_sr={range_id}/{name}")

    def read(self) -> DataFrame | None:
        """The history. Buckets that are split by sequence hold versions per
        range, which are joined up here."""
        directory = self.directory()
        ranged = directory.ranged()
        whole = self._history([p for p in directory.places() if p[0] not in ranged])
        if whole is None:
            return None
        whole = whole.drop(*AT)
        if not ranged:
            return whole
        parts = self._history([p for p in directory.places() if p[0] in ranged]).drop(*AT, "valid_to")
        joined = scd2_history(parts.withColumnRenamed("valid_from", self.sequence), self.keys, self.sequence, self.untracked,
                              materialize_steps=self.materialize_steps)
        return whole.unionByName(joined)
