"""Calendars, month-end spines and report skeletons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.ordered import KeyStats, Ordered, ordinal

#: More months than any entity is reported on.
MOST_MONTHS = 1200
#: Spans that share a row of a month.
SHARED = 64


def month_end_sequence(start: Column, end: Column) -> Column:
    """Month ends from the month of ``start`` to that of ``end``; empty if reversed."""
    lo, hi = F.trunc(start, "MM"), F.trunc(end, "MM")
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>")
    )
    return F.transform(months, lambda d: F.last_day(d))


def monthly_spine(
    df: DataFrame, start: str, end: str | None, as_of, name: str = "reporting_date", after=None
) -> DataFrame:
    """One row per entity and month end between its first month and its last.

    Only month ends up to ``as_of`` (and after ``after``) are kept.  Built by
    expanding each row, so there is no join with a calendar.
    """
    now = F.lit(as_of).cast("date")
    hi = now if end is None else F.least(F.coalesce(F.col(end).cast("date"), now), now)
    out = df.withColumn(name, F.explode(month_end_sequence(F.col(start).cast("date"), hi)))
    out = out.filter(F.col(name) <= now)
    return out if after is None else out.filter(F.col(name) > F.lit(after).cast("date"))


def monthly_shared(
    df: DataFrame, keys: list[str], start: str, end: str, as_of, spans: str, name: str = "reporting_date", after=None, sizes: KeyStats | None = None
) -> DataFrame:
    """``monthly_spine`` with one row per key and month end for up to ``SHARED`` of its spans.

    ``spans`` is an array of (start, end) of those that have the month; inlined, the rows are those of ``monthly_spine``
    for distinct spans, so what is looked up by key and month is looked up once for all of them.
    """
    d = Ordered(df.select(*keys, start, end).distinct(), keys, [start, end], sizes=sizes).scan(_wm_n=ordinal()).frame()
    lot = F.floor((F.col("_wm_n") - 1) / SHARED).alias("_wm_lot")
    last = F.when(F.count(end) == F.count(F.lit(1)), F.max(end))
    d = d.groupBy(*keys, lot).agg(F.min(start).alias("_wm_from"), last.alias("_wm_to"), F.collect_list(F.struct(start, end)).alias(spans))
    d = monthly_spine(d, "_wm_from", "_wm_to", as_of, name, after).drop("_wm_from", "_wm_to", "_wm_lot")
    open_ = lambda s: (F.last_day(s[start]) <= F.col(name)) & (s[end].isNull() | (F.last_day(s[end]) >= F.col(name)))
    return d.withColumn(spans, F.filter(spans, open_)).filter(F.size(spans) > 0)


def month_end_from(at: Column, as_of, after=None) -> Column:
    """The first month end of ``monthly_spine`` that is not before the moment ``at``; null if that is after ``as_of``."""
    day = at.cast("date")
    end = F.last_day(F.when(at > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day))
    if after is not None:
        end = F.greatest(end, F.last_day(F.date_add(F.lit(after).cast("date"), 1)))
    return F.when(end <= F.lit(as_of).cast("date"), end)


def skeleton(df: DataFrame, **dimensions: list | Column) -> DataFrame:
    """Every combination of the rows of ``df`` with literal lists (or array columns)."""
    out = df
    for name, values in dimensions.items():
        arr = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])
        out = out.withColumn(name, F.explode(arr))
    return out


def kpi_long(
    measures: DataFrame, keys: list[str], columns: list[str], frame: DataFrame, indicator: str, total: str
) -> DataFrame:
    """Wide measures to one row per indicator on a full skeleton; missing is 0."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias(indicator), F.col(c).cast("long").alias(total)) for c in columns])
    )
    long = measures.select(*keys, pairs.alias("_p")).select(*keys, "_p.*")
    return frame.join(long, [*keys, indicator], "left").withColumn(total, F.coalesce(F.col(total), F.lit(0)))


# Holiday rules as (name, test) pairs; a later rule overrides an earlier one.
UK_HOLIDAYS = [
    ("Good Friday", 4, 18),
    ("Easter Monday", 4, 21),
    ("Early May Bank Holiday", 5, 5),
    ("Spring Bank Holiday", 5, 26),
    ("Summer Bank Holiday", 8, 25),
    ("Christmas Day", 12, 25),
    ("Boxing Day", 12, 26),
    ("New Year's Day", 1, 1),
]
USA_HOLIDAYS = [
    ("Thanksgiving Day", "month = 11 AND dow = 5 AND nth = 4"),
    ("Christmas Day", "month = 12 AND dom = 25"),
    ("Independance Day", "month = 7 AND dom = 4"),
    ("New Year's Day", "month = 1 AND dom = 1"),
    ("Memorial Day", "month = 5 AND dow = 2 AND dom + 7 > 31"),
    ("Labor Day", "month = 9 AND dow = 2 AND nth = 1"),
    ("Valentine's Day", "month = 2 AND dom = 14"),
    ("Saint Patrick's Day", "month = 3 AND dom = 17"),
    ("Martin Luthor King Jr Day", "month = 1 AND dow = 2 AND year >= 1983 AND nth = 3"),
    ("President's Day", "month = 2 AND dow = 2 AND nth = 3"),
    ("Mother's Day", "month = 5 AND dow = 1 AND nth = 2"),
    ("Father's Day", "month = 6 AND dow = 1 AND nth = 3"),
    ("Halloween", "month = 10 AND dom = 31"),
    ("Election Day", "month = 11 AND dow = 3 AND dom BETWEEN 2 AND 8"),
]


def days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    first = F.lit(start).cast("date")
    n = spark.sql(f"SELECT datediff(DATE'{end}', DATE'{start}') + 1").first()[0]
    return spark.range(n).select(F.date_add(first, F.col("id").cast("int")).alias("day"))


def calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """The 37 columns of the date dimension from a table of days.

    Weeks start on Sunday and the week of January 1 is week 1.  The n-th
    weekday of a month, quarter or year follows from the day number alone.
    """
    d = F.col(day)
    txt = lambda c: c.cast("string")
    year_start, month_start, quarter_start = F.trunc(d, "year"), F.trunc(d, "MM"), F.trunc(d, "quarter")
    week = lambda c: F.floor((F.dayofyear(c) + F.dayofweek(F.trunc(c, "year")) - 2) / 7) + 1
    dom = F.dayofmonth(d)
    suffix = (
        F.when(dom.isin(11, 12, 13), "th")
        .when(dom % 10 == 1, "st")
        .when(dom % 10 == 2, "nd")
        .when(dom % 10 == 3, "rd")
        .otherwise("th")
    )
    quarter = F.quarter(d)
    base = days.select(
        d.alias("_d"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        dom.alias("dom"),
        F.dayofweek(d).alias("dow"),
        F.ceil(dom / 7).alias("nth"),
    )
    uk = F.lit(None).cast("string")
    for name, m, n in UK_HOLIDAYS:
        uk = F.when((F.col("month") == m) & (F.col("dom") == n), name).otherwise(uk)
    usa = F.lit(None).cast("string")
    for name, test in USA_HOLIDAYS:
        usa = F.when(F.expr(test), name).otherwise(usa)
    base = base.withColumns({"_uk": uk, "_usa": usa}).withColumnRenamed("_d", day)
    return base.select(
        F.date_format(d, "yyyyMMdd").alias("DateKey"),
        d.cast("timestamp_ntz").alias("Date"),
        F.date_format(d, "dd/MM/yyyy").alias("FullDateUK"),
        F.date_format(d, "MM/dd/yyyy").alias("FullDateUSA"),
        txt(dom).alias("DayOfMonth"),
        F.concat(txt(dom), suffix).alias("DaySuffix"),
        F.date_format(d, "EEEE").alias("DayName"),
        txt(F.dayofweek(d)).alias("DayOfWeekUSA"),
        txt((F.dayofweek(d) + 5) % 7 + 1).alias("DayOfWeekUK"),
        txt(F.col("nth")).alias("DayOfWeekInMonth"),
        txt(F.ceil(F.dayofyear(d) / 7)).alias("DayOfWeekInYear"),
        txt(F.floor(F.datediff(d, quarter_start) / 7) + 1).alias("DayOfQuarter"),
        txt(F.dayofyear(d)).alias("DayOfYear"),
        txt(week(d) + 1 - week(month_start)).alias("WeekOfMonth"),
        txt(F.floor(F.datediff(d, quarter_start) / 7) + 1).alias("WeekOfQuarter"),
        txt(week(d)).alias("WeekOfYear"),
        txt(F.month(d)).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        txt((F.month(d) - 1) % 3 + 1).alias("MonthOfQuarter"),
        F.concat(F.lit("Q"), txt(quarter)).alias("Quarter"),
        F.element_at(F.array(*map(F.lit, ["First", "Second", "Third", "Fourth"])), quarter).alias("QuarterName"),
        F.concat(F.lit("Q"), txt((quarter + 1) % 4 + 1)).alias("Fiscal_Quarter"),
        txt(F.year(d)).alias("Year"),
        F.concat(F.lit("CY "), txt(F.year(d))).alias("YearName"),
        F.date_format(d, "MMM-yyyy").alias("MonthYear"),
        F.date_format(d, "MMyyyy").alias("MMYYYY"),
        month_start.alias("FirstDayOfMonth"),
        F.last_day(d).alias("LastDayOfMonth"),
        quarter_start.alias("FirstDayOfQuarter"),
        F.last_day(F.add_months(quarter_start, 2)).alias("LastDayOfQuarter"),
        year_start.alias("FirstDayOfYear"),
        F.last_day(F.add_months(year_start, 11)).alias("LastDayOfYear"),
        F.col("_usa").isNotNull().alias("IsHolidayUSA"),
        (~F.dayofweek(d).isin(1, 7)).alias("IsWeekday"),
        F.col("_usa").alias("HolidayUSA"),
        F.col("_uk").isNotNull().alias("IsHolidayUK"),
        F.col("_uk").alias("HolidayUK"),
    )
