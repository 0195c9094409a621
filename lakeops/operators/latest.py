"""Latest record per key and newest-N per key.

Two physical strategies:

* ``window`` -- ``row_number() over (partition by keys order by ...) = 1``.
  Catalyst turns the filter into a partial ``WindowGroupLimit`` before the
  shuffle and a final one after it, so a key holding a third of all rows
  ships at most one row per map partition.
* ``aggregate`` -- ``max(struct(order..., payload))`` grouped by the keys;
  a hash aggregate with map-side combine. Best when duplicates are many.
  Only for all-descending orders (the latest-record rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = str | Column


def _order_cols(order_by: Sequence[OrderSpec], descending: bool) -> list[Column]:
    out = []
    for c in order_by:
        if isinstance(c, Column):
            out.append(c)
        else:
            out.append(F.col(c).desc() if descending else F.col(c).asc())
    return out


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  strategy: str = "window") -> DataFrame:
    """Keep the row with the greatest ``order_by`` tuple per ``keys``.

    ``order_by`` lists the sequence columns, most significant first (for the
    landing tables: batch date, ingest time), followed by tie-break columns
    so the winner is defined. Nulls rank lowest (``desc nulls last``).
    """
    keys, order_by = list(keys), list(order_by)
    if strategy == "window":
        return top_n_by_key(df, keys, order_by, 1)
    if strategy == "aggregate":
        payload = [c for c in df.columns if c not in keys]
        best = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                              F.struct(*payload).alias("_row"))).alias("_best")
        return (df.groupBy(*keys).agg(best)
                .select(*keys, "_best._row.*")
                .select(*df.columns))
    raise ValueError(f"unknown strategy {strategy!r}")


def top_n_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[OrderSpec], n: int,
                 descending: bool = True, rank_col: str | None = None) -> DataFrame:
    """Newest ``n`` rows per key (``row_number() <= n``)."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by, descending))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def sorted_limit(df: DataFrame, order_by: Sequence[OrderSpec], n: int | None) -> DataFrame:
    """Plain ordered limit (T4): a top-k, which Spark runs as
    ``TakeOrderedAndProject`` -- each task keeps only ``n`` rows."""
    out = df.orderBy(*_order_cols(order_by, descending=False))
    return out.limit(n) if n is not None else out
