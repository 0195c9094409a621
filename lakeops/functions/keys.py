"""Key expressions: integer date keys and hash surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text a null part of a surrogate key hashes as, and the
# separator between parts. Both must equal the dbt_utils convention so keys
# agree with tables built by the SQL project.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """``yyyyMMdd`` as int (dates and timestamps), without a text in between
    but for years before 1, which the text counts as years of their era."""
    c = _c(c)
    number = F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    return F.when(F.year(c) > 0, number).otherwise(F.date_format(c, "yyyyMMdd").cast("int"))


def month_key(c: str | Column) -> Column:
    """``yyyyMM`` as int."""
    return F.date_format(_c(c), "yyyyMM").cast("int")


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """md5 over the parts cast to text, nulls replaced, joined with '-'."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SURROGATE_SEP))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def iso_utc(ts: str | Column) -> Column:
    """ISO-8601 text of a timestamp in UTC, e.g. ``2024-01-02T03:04:05.000006Z``."""
    c = _c(ts).cast("timestamp")
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def batch_day(ts: str | Column) -> Column:
    """UTC day of a timestamp as a ``yyyyMMdd`` batch id (text)."""
    c = _c(ts).cast("timestamp")
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyyMMdd")
