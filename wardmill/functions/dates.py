"""Date and text expressions.

Two families of date differences are kept apart by name: ``*_crossed`` counts
calendar boundaries between two dates, ``complete_*`` counts whole units.
Nothing here reads the clock; callers pass the moment of the report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_crossed(a: Column, b: Column) -> Column:
    return F.year(b) - F.year(a)


def months_crossed(a: Column, b: Column) -> Column:
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def days_crossed(a: Column, b: Column) -> Column:
    return F.datediff(b.cast("date"), a.cast("date"))


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def complete_years(a: Column, b: Column) -> Column:
    return F.timestamp_diff("YEAR", _ntz(a), _ntz(b)).cast("int")


def complete_months(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MONTH", _ntz(a), _ntz(b)).cast("int")


def complete_days(a: Column, b: Column) -> Column:
    return F.timestamp_diff("DAY", _ntz(a), _ntz(b)).cast("int")


def minutes_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MINUTE", _ntz(a), _ntz(b))


def age_tenths(birth: Column, at: Column) -> Column:
    """Age in years to one decimal, from days / 365.25."""
    return F.round(F.datediff(at.cast("date"), birth.cast("date")) / F.lit(365.25), 1)


def months_since_birthday(birth: Column, at: Column) -> Column:
    """Complete months since the last birthday."""
    return complete_months(birth, at) % 12


def days_since_month_day(birth: Column, at: Column) -> Column:
    """Days since the birth day last came round in a month."""
    b, a = birth.cast("date"), at.cast("date")
    return F.datediff(a, F.add_months(b, complete_months(b, a)))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("int")


def entered_later_same_clock(event: Column, entered: Column, seconds: int = 1800) -> Column:
    """1 if the clock times differ by more than ``seconds``; the dates are not looked at."""
    return F.when(seconds_of_day(entered) - seconds_of_day(event) > seconds, 1).otherwise(0)


def trailing_months_start(as_of, months: int = 13) -> Column:
    """First day of the window that reaches ``months`` calendar months back."""
    return F.date_add(F.last_day(F.add_months(F.lit(as_of).cast("date"), -months)), 1)


def yes_no(code: Column, yes, no) -> Column:
    return F.when(code == yes, True).when(code == no, False)


def in_list(value: Column, csv: Column | str) -> Column:
    """Membership in a comma-separated list."""
    arr = F.split(F.lit(csv) if isinstance(csv, str) else csv, ",")
    return F.array_contains(arr, value.cast("string"))


def list_rank(value: Column, values: list) -> Column:
    """Place in a list, 0 when absent."""
    out = F.lit(0)
    for i, v in reversed(list(enumerate(values, 1))):
        out = F.when(value == v, i).otherwise(out)
    return out


def concat_skip_null(*cols: Column) -> Column:
    """Concatenation that treats null as empty text."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
