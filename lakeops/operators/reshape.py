"""Reshaping: struct expansion, array/map explode, unpivot, unions."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def expand_struct(df: DataFrame, struct_col: str, keep: Sequence[str | Column] = ()) -> DataFrame:
    """``keep`` columns next to ``struct_col.*``; raise on clashing names."""
    inner = df.schema[struct_col].dataType
    if not isinstance(inner, T.StructType):
        raise TypeError(f"{struct_col} is not a struct")
    kept = [k if isinstance(k, str) else None for k in keep]
    clash = {n for n in kept if n} & set(inner.fieldNames())
    if clash:
        raise ValueError(f"struct fields clash with kept columns: {sorted(clash)}")
    return df.select(*keep, f"{struct_col}.*")


def explode_records(df: DataFrame, array_col: str, alias: str = "record") -> DataFrame:
    """One row per array element; a null or empty array gives no row."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, F.explode(array_col).alias(alias))


def map_to_rows(df: DataFrame, map_col: str | Column, key_alias: str = "key",
                value_alias: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per map entry (P4). A null map gives no row."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    return df.select(*keep, F.explode(m).alias(key_alias, value_alias))


def unpivot(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
            name_col: str = "line_item", value_col: str = "line_item_value",
            cast: str = "double", tag: Mapping[str, str] | None = None) -> DataFrame:
    """Wide to long (P5): one row per (id, measure), nulls kept; optional
    constant tag columns (P6). Measures are cast first so the long column
    has one type."""
    base = df.select(*ids, *[F.col(m).cast(cast).alias(m) for m in measures])
    long = base.unpivot(list(ids), list(measures), name_col, value_col)
    if tag:
        long = long.select(*ids, *[F.lit(v).alias(k) for k, v in tag.items()], name_col, value_col)
    return long


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Fold ``unionByName`` over a list (U1, U2); with ``allow_missing`` the
    columns a branch lacks are null (U3)."""
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(frames))
