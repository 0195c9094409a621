"""Incremental facts: lookback filter, merge on a unique key, stored tables
(K2-K5, J9, A7, Z3).

* ``lookback_filter`` keeps source rows with ``date >= max(target date) - N``.
  The bound is one scalar subquery over the target and a plain comparison, so
  it reaches the source scan's pushed filters. Difference to the SQL
  project: an empty target (null max) loads everything instead of nothing.
* ``merge_upsert`` -- target rows whose key is absent from the source,
  plus every source row: matched rows are updated, new ones inserted,
  nothing deleted. Source keys must be unique (checked in the same job); rows
  with a null key part never match and always insert.
* ``incremental_build`` -- first run (no target) builds from the full
  source; later runs merge the lookback slice.
* ``full_refresh`` and ``merge_partitions`` store the result with Spark's own
  writes: overwrite, and dynamic partition overwrite of the partitions a
  merge touches. The new rows are written to the shared folder first, so
  neither reads what it replaces. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.keyfilter import candidates, write_filters
from lakeops.session import materialize
from lakeops.sources import fs

#: Name of the stored partition column, and of the flag of a table's own rows
#: (a partition that a merge empties is overwritten by a row without it).
PART, LIVE = "_part", "_live"


def lookback_filter(source: DataFrame, target: DataFrame | None, date_col: str, days: int,
                    target_date_col: str | None = None, anchor=None) -> DataFrame:
    """Source rows on or after ``anchor - days``; ``anchor`` defaults to the
    target's greatest date. No target, or an empty one: all rows."""
    if target is None:
        return source
    if anchor is None:
        if target.select(target_date_col or date_col).isEmpty():
            return source  # null dates too
        bound = target.agg(F.coalesce(F.date_sub(F.max(target_date_col or date_col), days),
                                      F.lit("0001-01-01").cast("date")).alias("_bound"))
        return source.filter(F.col(date_col) >= bound.scalar())
    return source.filter(F.col(date_col) >= F.date_sub(F.lit(anchor).cast("date"), days))


def _assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise inside the job when a key without a null part occurs twice. A
    grouped count (combined before its shuffle) is asked once, so a heavily
    repeated key isn't gathered."""
    twice = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    found = twice.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return df.filter(F.when(found == 0, F.lit(True)).otherwise(
        F.raise_error(F.lit("merge source has duplicate keys"))))


def merge_upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                 check_unique: bool = True) -> DataFrame:
    """Update matched keys, insert new ones, keep the rest of the target."""
    keys = list(keys)
    src = _assert_unique(source, keys) if check_unique else source
    if target is None:
        return src
    kept = target.join(source.select(*keys), keys, "left_anti")
    # null keys never match: such target rows stay, such source rows insert
    return kept.unionByName(src.select(*target.columns))


def incremental_build(source: DataFrame, target: DataFrame | None, keys: Sequence[str],
                      date_col: str, lookback_days: int, full_refresh: bool = False) -> DataFrame:
    """``is_incremental()``: full build on the first run (or on request),
    else merge of the lookback slice."""
    if target is None or full_refresh:
        return merge_upsert(None, source, keys)
    return merge_upsert(target, lookback_filter(source, target, date_col, lookback_days), keys)


def full_refresh(df: DataFrame, path: str, expectations=()) -> dict:
    """Overwrite the table at ``path``. With ``expectations`` the rules are
    observed while the new rows are staged; a violated ``fail`` rule raises
    and the table stays as it was. Returns the rules' counts."""
    from lakeops.operators.expectations import apply_expectations, check
    counts, obs = {}, None
    if expectations:
        df, obs = apply_expectations(df, expectations, guard_fail=False)
    staged = materialize(df, "refresh")
    if obs is not None:
        counts = check(obs, expectations)
    staged.write.mode("overwrite").parquet(path)
    return counts


def partition_text(value: Column) -> Column:
    """A partition's name, one per value whatever the type, null included."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null"))


def write_partitions(df: DataFrame, path: str, partition: Column, keys: Sequence[str] = ()) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows of (all of a
    new table). With ``keys`` a filter of each partition's keys is kept beside
    the table (``lakeops.operators.keyfilter``), written first."""
    if keys:
        df = materialize(df, "partition-rows")
        _filter_keys(df.sparkSession, path, df, keys, partition)
    (df.withColumn(PART, partition_text(partition)).withColumn(LIVE, F.lit(True)).hint("rebalance", PART)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))


def _filter_keys(spark, path: str, df: DataFrame, keys: Sequence[str], partition: Column) -> None:
    """Filters for the partitions of ``df`` that lack no key whatever breaks
    off: of the rows that will be there and of those that still are."""
    new = df.select(*keys, partition_text(partition).alias(PART))
    names = sorted(r[0] for r in new.select(PART).distinct().collect())
    old = read_partitions(spark, path, df.schema, names)
    both = new if old is None else new.union(old.select(*keys, partition_text(partition).alias(PART)))
    write_filters(spark, path, both, keys)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType,
                    names: Sequence[str] | None = None) -> DataFrame | None:
    """The stored rows (of the named partitions); None if there is no table."""
    if not fs.exists(spark, path):
        return None
    stored = T.StructType([*schema.fields, T.StructField(LIVE, T.BooleanType()), T.StructField(PART, T.StringType())])
    df = spark.read.schema(stored).parquet(path).filter(LIVE)
    if names is not None:
        df = df.filter(F.col(PART).isin(list(names)))
    return df.select(*schema.names)


def merge_partitions(path: str, source: DataFrame, keys: Sequence[str], partition: Column,
                     keys_fix_partition: bool = False, staged: bool = False, check_unique: bool = True) -> list[str]:
    """Upsert ``source`` into the table at ``path``, rewriting only the
    partitions it touches: those of its rows and those that hold a matched key
    (a row whose date moved leaves its old partition). The latter are looked
    for in the partitions whose key filter says that they may hold one, not in
    the whole table; a table written without filters gets them here.
    ``keys_fix_partition`` says that a key's partition can't change, which
    spares the filters and the search; ``staged`` that the source is a written
    table already; ``check_unique=False`` that its keys are unique. Returns the
    touched partitions' names."""
    spark, schema, keys = source.sparkSession, source.schema, list(keys)
    # read for the touched partitions, the moved keys and the merge itself
    source = source if staged else materialize(source, "merge-source")
    there = fs.exists(spark, path)
    touched = source.select(partition_text(partition).alias(PART))
    if there and not keys_fix_partition:
        maybe = candidates(spark, path, source, keys)
        if maybe is None:
            _filter_keys(spark, path, read_partitions(spark, path, schema), keys, partition)
            maybe = candidates(spark, path, source, keys)
        if maybe:
            moved = read_partitions(spark, path, schema, maybe).join(source.select(*keys), keys, "left_semi")
            touched = touched.union(moved.select(partition_text(partition)))
    # names of partitions only: bounded by the table's partitions
    names = sorted(r[0] for r in touched.distinct().collect())
    old = read_partitions(spark, path, schema, names)
    rows = materialize(merge_upsert(old, source, keys, check_unique), "merge-rows")
    if not keys_fix_partition and names:
        _filter_keys(spark, path, rows, keys, partition)
    merged = rows.withColumn(PART, partition_text(partition)).withColumn(LIVE, F.lit(True))
    if there and names:
        # a row that isn't the table's own, so that an emptied partition is replaced too
        mark = spark.createDataFrame([(n,) for n in names], f"{PART} string")
        merged = merged.unionByName(mark.withColumn(LIVE, F.lit(False)), allowMissingColumns=True)
    # rebalanced: few files a partition, and a large partition over several tasks
    merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return names
