"""Point-in-time left join of facts to a versioned dimension.

A fact matches the version of its key whose half-open interval
``[valid_from, coalesce(valid_to, 9999-12-31))`` holds the fact's event time;
dates and timestamps compare as timestamps. Facts without a match, and facts
with a null key or time, keep a null dimension side; zero-length versions
never match. Three physical strategies for the caller to choose from, with
the same result on non-overlapping versions:

* ``range`` -- equi-join on the key plus the range as a residual. Spark picks
  a broadcast hash join when the dimension's measured size is under the
  broadcast threshold (AQE re-checks at run time), else a sort-merge join;
  AQE's skew handling splits a hot key's fact partition. Cost per fact grows
  with the versions of its key: for dimensions of few versions a key.
* ``bucketed`` -- adds a time bucket to the equi-key: each version is
  repeated once per bucket it overlaps, within the time the dimension's own
  bounds span (facts before or after fall into the first or last bucket), so a
  fact is compared only with the versions of its own bucket, and a hot
  key's facts spread over as many join keys as it has buckets.
* ``window`` -- union of facts and version starts, ``last(..., ignorenulls)``
  in time order, then the end check. Linear in rows, no fan-out; runs per
  (key, time bucket) with a carry-in row per bucket, so a hot key's facts
  spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def _dim_cols(dim: DataFrame, dim_key: str, valid_from: str, valid_to: str,
              attach: Sequence[str] | None) -> list[str]:
    if attach is not None:
        return list(attach)
    return [c for c in dim.columns if c not in (dim_key, valid_from, valid_to)]


def pit_join(facts: DataFrame, dim: DataFrame, fact_key: str, event_col: str,
             dim_key: str = "symbol", valid_from: str = "scd_effective_from",
             valid_to: str = "scd_effective_to", attach: Sequence[str] | None = None,
             strategy: str = "range", bucket_unit: str = "year",
             check_overlap: bool = False) -> DataFrame:
    """Left join ``facts`` to the ``dim`` version valid at ``event_col``.

    Returns all fact columns plus ``attach`` (default: every dimension column
    except its key and interval), which must not clash with fact columns.
    ``check_overlap`` first verifies (one pass over the dimension) that no
    versions overlap, which would duplicate facts.
    """
    if check_overlap:
        assert_no_overlap(dim, dim_key, valid_from, valid_to)
    attach = _dim_cols(dim, dim_key, valid_from, valid_to, attach)
    clash = set(attach) & set(facts.columns)
    if clash:
        raise ValueError(f"dimension columns clash with fact columns: {sorted(clash)}")
    if strategy == "range":
        return _pit_range(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach)
    if strategy == "bucketed":
        return _pit_bucketed(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to,
                             attach, bucket_unit)
    if strategy == "window":
        return _pit_window(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach)
    raise ValueError(f"unknown strategy {strategy!r}")


def _end(valid_to: str):
    return F.coalesce(F.col(valid_to).cast("timestamp"), F.lit(OPEN_END).cast("timestamp"))


def _holds(event_col: str):
    """The version's interval (columns _df, _dt) holds the event time."""
    event = F.col(event_col).cast("timestamp")
    return (event >= F.col("_df")) & (event < F.col("_dt"))


def _versions(dim, dim_key, valid_from, valid_to, attach):
    return dim.select(F.col(dim_key).alias("_dk"), F.col(valid_from).cast("timestamp").alias("_df"),
                      _end(valid_to).alias("_dt"), *attach)


def _pit_range(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach):
    d = _versions(dim, dim_key, valid_from, valid_to, attach)
    return facts.join(d, (F.col(fact_key) == F.col("_dk")) & _holds(event_col), "left").select(*facts.columns, *attach)


def _pit_bucketed(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach, unit):
    d = _versions(dim, dim_key, valid_from, valid_to, attach).filter(F.col("_dt") > F.col("_df"))
    # buckets matter between the first end and the last start; times outside
    # fall into the first or last one (one row of bounds, from the dimension)
    row = d.agg(F.min("_dt").alias("lo"), F.max("_df").alias("hi")).first()
    if row["lo"] is None:  # no version: nothing can match
        return _pit_range(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach)
    lo, hi = F.lit(min(row["lo"], row["hi"])), F.lit(row["hi"])
    bucket = lambda c: F.date_trunc(unit, F.least(F.greatest(c, lo), hi))
    d = d.withColumn("_bk", F.explode(F.sequence(bucket(F.col("_df")), bucket(F.col("_dt")), F.expr(f"interval 1 {unit}"))))
    event = F.col(event_col).cast("timestamp")
    f = facts.withColumn("_fb", F.when(event.isNotNull(), bucket(event)))
    cond = (F.col(fact_key) == F.col("_dk")) & (F.col("_fb") == F.col("_bk")) & _holds(event_col)
    return f.join(d, cond, "left").select(*facts.columns, *attach)


def _pit_window(facts, dim, fact_key, event_col, dim_key, valid_from, valid_to, attach, unit="month"):
    """Two-level window, so no key's rows meet in one task.

    1. Facts and version starts are tagged with a time bucket; the window
       runs per (key, bucket) in time order, versions before facts on ties.
    2. A fact whose bucket holds no earlier version start needs the version
       that was current when the bucket began: the last version started in
       an earlier bucket. It comes from a small per-key window over one row
       per (key, bucket) and is put into the bucket as a carry-in row.
    """
    fcols = facts.columns
    ver_t = _version_type(dim, valid_to, attach)
    fact_t = facts.select(F.struct(*fcols)).schema[0].dataType
    bucket = lambda c: F.date_trunc(unit, c)  # noqa: E731  (timestamp, monotone)
    f = facts.select(F.col(fact_key).alias("_k"), F.col(event_col).cast("timestamp").alias("_t"),
                     F.lit(2).alias("_tag"), F.struct(*fcols).alias("_f"), F.lit(None).cast(ver_t).alias("_ver"))
    f = f.withColumn("_bk", bucket(F.col("_t")))
    d = (dim.filter(F.col(dim_key).isNotNull() & (_end(valid_to) > F.col(valid_from).cast("timestamp")))
         .select(F.col(dim_key).alias("_k"), F.col(valid_from).cast("timestamp").alias("_t"),
                 F.lit(1).alias("_tag"), F.lit(None).cast(fact_t).alias("_f"),
                 F.struct(F.col(valid_to).alias("_end"), *attach).alias("_ver"))
         .withColumn("_bk", bucket(F.col("_t"))))
    # per (key, bucket): the last version started in it; plus every bucket with facts
    last_in_bucket = d.groupBy("_k", "_bk").agg(F.max(F.struct("_t", "_ver"))["_ver"].alias("_last"))
    fact_buckets = f.select("_k", "_bk").distinct().withColumn("_last", F.lit(None).cast(ver_t))
    wk = Window.partitionBy("_k").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (last_in_bucket.unionByName(fact_buckets)
             .groupBy("_k", "_bk").agg(F.max("_last").alias("_last"))  # one row per (key, bucket)
             .withColumn("_in", F.last("_last", ignorenulls=True).over(wk))
             .filter(F.col("_in").isNotNull())
             .select("_k", "_bk", F.col("_bk").alias("_t"), F.lit(0).alias("_tag"),
                     F.lit(None).cast(fact_t).alias("_f"), F.col("_in").alias("_ver")))
    w = (Window.partitionBy("_k", "_bk").orderBy("_t", "_tag")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = (f.unionByName(d).unionByName(carry)
         .withColumn("_cur", F.last("_ver", ignorenulls=True).over(w))
         .filter(F.col("_tag") == 2))
    ok = F.col("_cur").isNotNull() & (
        F.col("_cur._end").isNull() | (F.col("_t") < F.col("_cur._end").cast("timestamp")))
    return u.select(*[F.col("_f")[c].alias(c) for c in fcols],
                    *[F.when(ok, F.col("_cur")[c]).alias(c) for c in attach])


def _version_type(dim: DataFrame, valid_to: str, attach: Sequence[str]):
    return dim.select(F.struct(F.col(valid_to).alias("_end"), *attach)).schema[0].dataType


def overlapping_versions(dim: DataFrame, dim_key: str = "symbol", valid_from: str = "scd_effective_from",
                         valid_to: str = "scd_effective_to") -> DataFrame:
    """Versions that start before the previous version of their key ended
    (they would make a point-in-time join fan out). Zero-length versions are
    ignored: they never match."""
    live = dim.withColumns({"_s": F.col(valid_from).cast("timestamp"), "_e": _end(valid_to)}).filter(F.col("_e") > F.col("_s"))
    live = live.withColumn("_bk", F.date_trunc("month", "_s"))
    # greatest end before a row: within its own month's starts, or of earlier months
    here = Window.partitionBy(dim_key, "_bk").orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    months = live.groupBy(F.struct(dim_key).alias("_k"), "_bk").agg(F.max("_e").alias("_most"))
    before = Window.partitionBy("_k").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("_k", F.col("_bk").alias("_m"), F.max("_most").over(before).alias("_past"))
    rows = live.withColumn("_prev_end", F.max("_e").over(here)).join(
        months, F.struct(dim_key).eqNullSafe(F.col("_k")) & F.col("_bk").eqNullSafe(F.col("_m")))
    return (rows.filter(F.col("_s") < F.greatest("_prev_end", "_past"))
            .select(*dim.columns))


class OverlappingVersions(ValueError):
    pass


def assert_no_overlap(dim: DataFrame, dim_key: str = "symbol", valid_from: str = "scd_effective_from",
                      valid_to: str = "scd_effective_to") -> None:
    n = overlapping_versions(dim, dim_key, valid_from, valid_to).count()
    if n:
        raise OverlappingVersions(f"{n} versions overlap an earlier version of their key")
