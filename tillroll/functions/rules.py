"""Row predicates and labels shared by many jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.schema import HOME_MARKET


def is_cancelled() -> Column:
    return F.startswith(F.col("Invoice"), F.lit("C"))


def is_valid_sale() -> Column:
    """A known customer's line on an invoice that is no cancellation. Price and quantity are not tested."""
    return F.col("CustomerID").isNotNull() & ~is_cancelled()


def is_priced() -> Column:
    return F.col("Price") > 0


def is_abroad() -> Column:
    return F.col("Country") != HOME_MARKET


def basket_size(units: Column) -> Column:
    return (
        F.when(units <= 5, "1. Tiny (1-5 items)")
        .when(units <= 15, "2. Small (6-15 items)")
        .when(units <= 50, "3. Medium (16-50 items)")
        .when(units <= 150, "4. Large (51-150 items)")
        .otherwise("5. Bulk (>150 items)")
    )


def ntile_of_rank(rank: Column, rows: Column, buckets: int) -> Column:
    """NTILE from a 1-based rank and the row count: the first ``rows % buckets`` tiles hold one row more."""
    size, extra = F.floor(rows / buckets), rows % buckets
    in_large = extra * (size + 1)
    return F.when(rank <= in_large, F.ceil(rank / (size + 1))).otherwise(
        F.ceil(F.try_divide(rank - in_large, size)) + extra
    ).cast("bigint")


def qcut_of_rank(rank: Column, rows: Column, buckets: int) -> Column:
    """Equal-frequency bin of a 1-based rank, edges interpolated linearly between ranks.

    Differs from NTILE on many sizes: the bins are right-closed intervals over
    ``1 + k * (rows - 1) / buckets``.
    """
    steps = (rank - 1) * buckets
    return F.greatest(F.lit(1), F.ceil(F.try_divide(steps, rows - 1)).cast("bigint"))
