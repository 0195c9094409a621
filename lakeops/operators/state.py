"""Latest rows per key, and sums over them, kept as stored tables.

Taking the latest row per key of everything delivered so far reads and
shuffles all deliveries at each run. ``LatestState`` stores the latest rows
instead: a run reads the state of the partitions that its deliveries' keys lie
in, decides these keys only (a late delivery with an older order loses, as it
would in a full build) and writes back what changed. It reports the changes,
each with the row it replaces, from which sums over the latest rows are kept
by ``merge_sums`` without reading the rows again. The result equals the full
build over all deliveries, in whatever order they came.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.latest import latest_by_key
from lakeops.operators.upsert import PART, merge_partitions, partition_text, read_partitions
from lakeops.session import materialize


class LatestState:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str], partition: Column):
        """``partition`` is made of key columns only: a key never moves."""
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order_by, self.partition = list(keys), list(order_by), partition

    def read(self) -> DataFrame | None:
        return read_partitions(self.spark, self.path, self.schema)

    def apply(self, deliveries: DataFrame) -> DataFrame:
        """Take in deliveries; returns the changed keys as (keys, old, new):
        the row that was the latest before (null for a new key) and is now."""
        row = F.struct(*self.schema.names)
        new = materialize(latest_by_key(deliveries.select(*self.schema.names), self.keys, self.order_by), "state-new")
        # names of partitions only
        names = sorted(r[0] for r in new.select(partition_text(self.partition).alias(PART)).distinct().collect())
        held = read_partitions(self.spark, self.path, self.schema, names)
        if held is None:  # the first run: all keys are new
            changed = new.select(*self.keys, F.lit(None).cast(new.select(row).schema[0].dataType).alias("old"), row.alias("new"))
            merge_partitions(self.path, new, self.keys, self.partition, keys_fix_partition=True, staged=True, check_unique=False)
            return changed
        # the keys' own rows only, before anything is compared; null parts are keys like others
        pair = lambda df, name: df.select(F.struct(*self.keys).alias("_k"), row.alias(name))
        both = pair(new, "new").join(pair(held, "old"), "_k", "left")
        order = lambda side: F.struct(*(F.col(f"{side}.{c}") for c in self.order_by))
        later = F.col("old").isNull() | (order("new") > order("old"))
        changed = materialize(both.where(later).select("_k.*", "old", "new"), "state-changes")
        merge_partitions(self.path, changed.select("new.*"), self.keys, self.partition, keys_fix_partition=True, staged=True, check_unique=False)
        return changed


def sum_changes(changes: DataFrame, groups: dict[str, Column], measures: dict[str, Column]) -> DataFrame:
    """What the changes add to each group's sums: the new row's measures less
    the old one's, in the groups that either lies in. Groups and measures are
    given over the row's columns; ``rows_added`` counts rows."""
    def side(name: str, sign: int) -> DataFrame:
        rows = changes.where(F.col(name).isNotNull()).select(f"{name}.*")
        return rows.select(*(c.alias(n) for n, c in groups.items()), *((c * sign).alias(n) for n, c in measures.items()), F.lit(sign).cast("long").alias("rows_added"))

    return side("new", 1).unionAll(side("old", -1)).groupBy(*groups).agg(*(F.sum(n).alias(n) for n in [*measures, "rows_added"]))


def merge_sums(path: str, added: DataFrame, groups: Sequence[str], partition: Column, staged: bool = False) -> list[str]:
    """Add to the stored sums of the groups (measures and ``rows_added``),
    rewriting only the partitions of these groups, which the groups fix.
    Groups that lose their last row stay with 0 ``rows_added``; ``staged`` says
    that ``added`` is a written table already."""
    spark, schema = added.sparkSession, added.schema
    added = added if staged else materialize(added, "sums-added")
    names = sorted(r[0] for r in added.select(partition_text(partition).alias(PART)).distinct().collect())
    held = read_partitions(spark, path, schema, names)
    if held is not None:
        mine = held.join(added.select(*groups), [held[g].eqNullSafe(added[g]) for g in groups], "left_semi")
        added = mine.unionByName(added).groupBy(*groups).agg(*(F.sum(c).alias(c) for c in schema.names if c not in groups)).select(*schema.names)
    return merge_partitions(path, added, groups, partition, keys_fix_partition=True, staged=staged and held is None, check_unique=False)
