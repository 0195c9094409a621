"""SCD2 history from snapshots.

``scd2_history`` turns a table of snapshots (several rows per key, ordered by a
sequence column such as a ``yyyyMMdd`` batch id) into half-open versions
``[valid_from, valid_to)``; the open version has a null end.

* tracked columns = all columns - keys - sequence - untracked - tie-break;
  a new version starts when any tracked column differs, null-safe, from the
  previous snapshot of the key;
* untracked columns are updated in place: a version carries the value of its
  latest snapshot;
* equal sequence values are reduced to one snapshot first (tie-break columns,
  then the remaining columns, decide).

Scale: a single key may hold a large share of all snapshots, so no step
puts all rows of a key into one task. Change detection runs per
(key, sequence bucket), the buckets being ranges of the data's own sequence
values, and gives each bucket's runs of equal tracked values. A run inside its
bucket is a version; the first and last run of each bucket (two rows at most
per key and bucket) meet per key, where neighbouring buckets' runs are joined
up and versions find their ends. Nothing is joined back to the snapshots. The
runs, which two branches read, are written once to the shared folder instead of
being recomputed per branch.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.keys import surrogate_key
from lakeops.operators.latest import latest_by_key
from lakeops.session import materialize


def sequence_bucket(df: DataFrame, sequence: str, buckets: int = 128) -> Column:
    """A monotone coarsening of the sequence column into about ``buckets``
    ranges of equal weight, whatever its type: bounds are approximate
    percentiles of the values (one aggregate over the one column). Text is
    ordered by the six bytes after the prefix that all values share. Null
    gives a null bucket, which comes first as null sequences do.
    """
    dt, c = df.schema[sequence].dataType, F.col(sequence)
    cuts = [i / buckets for i in range(1, buckets)]

    def text_code(shared: int) -> Column:
        tail = F.rpad(F.hex(F.substring(c.cast("binary"), shared + 1, 6)), 12, "0")
        return F.conv(tail, 16, 10).cast("double")

    if isinstance(dt, T.StringType):
        code = text_code(0)
    elif isinstance(dt, T.DateType):
        code = F.unix_date(c).cast("double")
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        code = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(dt, T.NumericType):
        code = c.cast("double")
    else:
        return c
    row = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.percentile_approx(code, cuts).alias("b")).first()
    # a long shared prefix leaves too few bounds: percentiles of what follows it
    if isinstance(dt, T.StringType) and row["lo"] is not None and len(set(row["b"] or [])) < buckets // 8 and (
            shared := len(os.path.commonprefix([row["lo"].encode(), row["hi"].encode()]))):
        code = text_code(shared)
        row = df.agg(F.percentile_approx(code, cuts).alias("b")).first()
    bounds = sorted(set(row["b"] or []))
    # position among the bounds, by halving
    def place(x: Column, lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x <= F.lit(bounds[mid]), place(x, lo, mid)).otherwise(place(x, mid + 1, hi))
    return F.when(c.isNotNull(), F.transform(F.array(code), lambda x: place(x, 0, len(bounds)))[0])


def scd2_history(df: DataFrame, keys: Sequence[str], sequence: str,
                 untracked: Sequence[str] = (), tie_break: Sequence[str] = (),
                 bucket: Column | None = None, valid_from: str = "valid_from",
                 valid_to: str = "valid_to", materialize_steps: bool = True, unique: bool = False) -> DataFrame:
    """Versions of ``df`` per key (see the module notes). ``unique`` says that
    a key has one row per sequence value already, which spares the dedup.

    The buckets' runs, which feed two branches, are written once under the
    shared folder when ``materialize_steps`` is true, so no branch recomputes
    the scan, dedup and shuffles before it (this runs a job when called); this
    is the default."""
    keys, untracked, tie_break = list(keys), list(untracked), list(tie_break)
    skip = set(keys) | {sequence} | set(untracked) | set(tie_break)
    tracked = [c for c in df.columns if c not in skip]
    if not tracked:
        raise ValueError("no tracked columns")

    # One snapshot per (key, sequence).
    snaps = df if unique else latest_by_key(df, keys + [sequence], tie_break + tracked + untracked)

    # Key and bucket travel as structs: equal structs match even when a field
    # is null (a null key or sequence keeps its own history instead of being
    # dropped by a join), and every step partitions on the same columns.
    b = bucket if bucket is not None else sequence_bucket(df, sequence)
    rows = snaps.select(F.struct(*keys).alias("_k"), sequence, *untracked,
                        F.struct(*tracked).alias("_t"), F.struct(b.alias("b")).alias("_b"))
    wb = Window.partitionBy("_k", "_b").orderBy(sequence)
    prev = F.lag("_t").over(wb)
    # null for the first row of a bucket: decided among the buckets' edges
    rows = rows.withColumn("_chg", F.when(prev.isNotNull(), ~F.col("_t").eqNullSafe(prev)))
    rows = rows.withColumn("_run", F.count_if("_chg").over(wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # one pass per run: the start row (smallest sequence, a null one first)
    # gives valid_from and the tracked values; struct max: the latest snapshot
    # gives the untracked ones. Buckets are partitioned as the runs need it
    runs = rows.groupBy("_k", "_b", "_run").agg(
        F.min(F.struct(F.col(sequence).alias("s"), F.col("_t").alias("t"))).alias("_start"),
        F.max(F.struct(F.col(sequence).alias("s"), *[F.col(c).alias(f"u{i}") for i, c in enumerate(untracked)])).alias("_last"))
    runs = runs.withColumn("_next", F.lead("_start.s").over(Window.partitionBy("_k", "_b").orderBy("_run")))
    if materialize_steps:  # read by the runs inside a bucket and by those at its edges
        runs = materialize(runs, "scd2-runs")

    # a run with others of its bucket before and after it is a version
    edge = (F.col("_run") == 0) | F.col("_next").isNull()
    inner = runs.filter(~edge).select("_k", "_start", "_last", F.col("_next").alias(valid_to))

    # the first run of a bucket may go on with the last one before it; at most
    # two rows per key and bucket, and all that follows is partitioned by key
    wk = Window.partitionBy("_k").orderBy("_b", "_run")
    starts = (F.col("_run") > 0) | ~F.col("_start.t").eqNullSafe(F.lag("_start.t").over(wk))
    edges = (runs.filter(edge).withColumn("_chg", starts)
             .withColumn("_v", F.count_if("_chg").over(wk.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    outer = edges.groupBy("_k", "_v").agg(F.min("_start").alias("_start"), F.max("_last").alias("_last"), F.max("_next").alias("_next"))
    # ends at the next run of its last bucket, or at the key's next version at an edge
    end = F.coalesce("_next", F.lead("_start.s").over(Window.partitionBy("_k").orderBy("_v")))
    outer = outer.select("_k", "_start", "_last", end.alias(valid_to))
    return inner.unionAll(outer).select(
        *[F.col("_k")[c].alias(c) for c in keys], *[F.col("_start.t")[c].alias(c) for c in tracked],
        *[F.col(f"_last.u{i}").alias(c) for i, c in enumerate(untracked)], F.col("_start.s").alias(valid_from), valid_to)


def dimension_view(history: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                   valid_to: str = "valid_to", key_col: str = "company_key",
                   backdate: str = "1900-01-01", date_format: str = "yyyyMMdd",
                   columns: Sequence[str | Column] | None = None) -> DataFrame:
    """Surface a history as a dimension (H4).

    * ``key_col`` hashes (keys, original start text);
    * the first version of each key is backdated to ``backdate`` so early facts
      still match; later versions start on their own date;
    * ``scd_effective_to`` is the end date (null = open), ``is_current`` = open.

    The first start per key comes from a grouped min joined back on the keys:
    one row per key, which AQE broadcasts when its measured size allows.
    """
    keys = list(keys)

    def as_date(c: str) -> Column:
        if isinstance(history.schema[c].dataType, T.StringType):
            return F.to_date(F.col(c), date_format)
        return F.col(c).cast("date")

    firsts = (history.groupBy(*keys).agg(F.min(valid_from).alias("_first_start"))
              .withColumnsRenamed({c: f"_f{c}" for c in keys}))
    cols = list(columns) if columns is not None else [
        c for c in history.columns if c not in set(keys) | {valid_from, valid_to}]
    end = as_date(valid_to)
    return (history.join(firsts, [history[c].eqNullSafe(F.col(f"_f{c}")) for c in keys])
            .select(surrogate_key([*keys, valid_from]).alias(key_col), *keys, *cols,
                    F.when(F.col(valid_from) == F.col("_first_start"), F.to_date(F.lit(backdate)))
                    .otherwise(as_date(valid_from)).alias("scd_effective_from"),
                    end.alias("scd_effective_to"),
                    end.isNull().alias("is_current")))
