"""Money stays DECIMAL, so that sums do not depend on their order, and becomes DOUBLE in the output."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LINE_REVENUE = "decimal(18,2)"


def line_revenue() -> Column:
    """Quantity x Price of one line."""
    return (F.col("Quantity") * F.col("Price")).cast(LINE_REVENUE)


def total(value: Column) -> Column:
    """A sum as the output shows it."""
    return F.sum(value).cast("double")


def mean(value: Column) -> Column:
    """Average from an exact sum; NULL without rows."""
    return ratio(F.sum(value), F.count(value))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` in doubles, NULL when the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(value: Column, digits: int) -> Column:
    """Round half up on the decimal digits, not on the binary ones."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(ratio(part.cast("double") * 100, whole), digits)


def big(value: Column) -> Column:
    return value.cast("bigint")
