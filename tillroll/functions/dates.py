"""Calendar keys and exact day differences on TIMESTAMP_NTZ columns, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# Keys to group by: dates and small integers, cheap per line. Their labels are
# made after the grouping, once per group.


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def quarter_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "quarter")


def year_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "year")


def week_number(ts: Column) -> Column:
    """Monday-first week 00-53; days before the first Monday are week 00."""
    return F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)


def year_label(day: Column) -> Column:
    return F.date_format(day, "yyyy")


def month_of_year(day: Column) -> Column:
    return F.date_format(day, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def week_label(year: Column, week: Column) -> Column:
    return F.concat(year_label(year), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day))


def whole_days(earlier: Column, later: Column) -> Column:
    """Full 24-hour periods from ``earlier`` to ``later``; not calendar days."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 as an integer, for exact arithmetic on times."""
    span = ts - F.expr(_EPOCH)
    seconds = (
        F.extract(F.lit("DAY"), span).cast("bigint") * 86_400
        + F.extract(F.lit("HOUR"), span) * 3_600
        + F.extract(F.lit("MINUTE"), span) * 60
    )
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")
