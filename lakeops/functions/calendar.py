"""Calendar dimension and exchange holidays.

The calendar is generated with ``spark.range`` (distributed, one row per day)
between two bounds, end exclusive. Holidays are not a shipped list: they
come from the exchange's published rules, evaluated as column expressions
over the same days, plus the few one-off closures listed below.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.keys import date_key

# One-off market closures (national days of mourning) that no
# calendar rule produces.
SPECIAL_CLOSURES = ["2018-12-05", "2025-01-09"]
JUNETEENTH_FROM = 2022
# Fixed value: the name every holiday row carries in the reference's table.
HOLIDAY_NAME = "NYSE Holiday"


def days(spark: SparkSession, start: str, end_exclusive: str, col: str = "date_day") -> DataFrame:
    n = (_dt.date.fromisoformat(end_exclusive) - _dt.date.fromisoformat(start)).days
    return spark.range(max(n, 0)).select(
        F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias(col))


def _nth_weekday(d: Column, month: int, weekday: int, n: int) -> Column:
    """d is the n-th given weekday (Spark numbering, Sunday=1) of month."""
    return ((F.month(d) == month) & (F.dayofweek(d) == weekday)
            & (F.ceil(F.dayofmonth(d) / 7) == n))


def _last_weekday(d: Column, month: int, weekday: int) -> Column:
    return (F.month(d) == month) & (F.dayofweek(d) == weekday) & (F.month(F.date_add(d, 7)) != month)


def _observed(d: Column, month: int, day: int, saturday_to_friday: bool = True) -> Column:
    """Fixed-date holiday moved to Monday when on Sunday, to Friday when on
    Saturday (unless the move would leave the year)."""
    on = (F.month(d) == month) & (F.dayofmonth(d) == day) & F.dayofweek(d).between(2, 6)
    nxt = F.date_sub(d, 1)
    sun = (F.month(nxt) == month) & (F.dayofmonth(nxt) == day) & (F.dayofweek(nxt) == 1)
    cond = on | sun
    if saturday_to_friday:
        prv = F.date_add(d, 1)
        cond = cond | ((F.month(prv) == month) & (F.dayofmonth(prv) == day) & (F.dayofweek(prv) == 7))
    return cond


def _easter(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous computus) as a date column."""
    a = year % 19
    b = F.floor(year / 100)
    c = year % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = ((h + l_ - 7 * m + 114) % 31) + 1
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def is_exchange_holiday(d: Column, years: tuple[int, int] | None = None) -> Column:
    """By today's rules, for any year; ``years`` (first, last) limits them to
    the years a holiday table covers."""
    y = F.year(d)
    rule = (_observed(d, 1, 1, saturday_to_friday=False)
            | _nth_weekday(d, 1, 2, 3)            # third Monday of January
            | _nth_weekday(d, 2, 2, 3)            # third Monday of February
            | (d == F.date_sub(_easter(y), 2))    # Good Friday
            | _last_weekday(d, 5, 2)              # last Monday of May
            | (_observed(d, 6, 19) & (y >= JUNETEENTH_FROM))
            | _observed(d, 7, 4)
            | _nth_weekday(d, 9, 2, 1)            # first Monday of September
            | _nth_weekday(d, 11, 5, 4)           # fourth Thursday of November
            | _observed(d, 12, 25)
            | d.isin(*[F.to_date(F.lit(s)) for s in SPECIAL_CLOSURES]))
    return rule if years is None else rule & y.between(*years)


def holidays(calendar: DataFrame, col: str = "date_day", years: tuple[int, int] | None = None) -> DataFrame:
    """Holiday table (holiday_date, holiday_name) for the days in ``calendar``."""
    return (calendar.filter(is_exchange_holiday(F.col(col), years))
            .select(F.col(col).alias("holiday_date"), F.lit(HOLIDAY_NAME).alias("holiday_name")))


def date_dimension(spark: SparkSession, start: str, end_exclusive: str,
                   holiday_table: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end_exclusive) with calendar attributes and
    weekday / holiday / market-open flags. Weeks start on Monday (ISO)."""
    cal = days(spark, start, end_exclusive)
    hol = holiday_table if holiday_table is not None else holidays(cal)
    d = F.col("date_day")
    week_start = F.date_trunc("week", d).cast("date")
    q_start = F.date_trunc("quarter", d).cast("date")
    weekend = F.dayofweek(d).isin(1, 7)
    flagged = cal.join(hol.select(F.col("holiday_date").alias("_h")), d == F.col("_h"), "left")
    is_hol = F.col("_h").isNotNull()
    return flagged.select(
        date_key(d).alias("date_key"),
        d,
        (((F.dayofweek(d) + 5) % 7) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        F.month(d).alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.trunc(d, "MM").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_of_year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        q_start.alias("quarter_start_date"),
        F.date_sub(F.add_months(q_start, 3), 1).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        (~weekend).alias("is_weekday"),
        is_hol.alias("is_holiday"),
        (~weekend & ~is_hol).alias("is_market_open"),
    )


HOLIDAY_SEED_SCHEMA = "holiday_date date, holiday_name string"


def read_holiday_seed(spark: SparkSession, path: str) -> DataFrame:
    """A holiday seed file (CSV with a header) read with declared column types,
    to use instead of the rules: ``date_dimension(..., holiday_table=...)``."""
    return spark.read.schema(HOLIDAY_SEED_SCHEMA).option("header", True).csv(path)
