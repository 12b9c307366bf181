"""The transaction-line table every job reads, and how jobs say which columns they need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, types as T

# One row per invoice line. An invoice starting with 'C' is a cancellation, a
# negative quantity a return, a NULL customer a guest.
TRANSACTIONS = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", T.DecimalType(12, 2)),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)
COLUMNS = TRANSACTIONS.fieldNames()
HOME_MARKET = "United Kingdom"


def reads(*columns: str, cancelled: bool | None = None) -> Callable:
    """Record which transaction columns a job touches.

    Where the table is assembled from several others, the loader joins only
    what these columns need (see ``sources.warehouse``). ``cancelled`` says that
    the job drops all lines but the cancelled ones, or all cancelled ones, so
    that the loader can filter on stored flags.
    """

    def mark(job):
        job.reads = columns
        job.cancelled = cancelled
        return job

    return mark


def required(job: Callable) -> tuple[str, ...]:
    return getattr(job, "reads", tuple(COLUMNS))


def wanted_lines(job: Callable) -> bool | None:
    return getattr(job, "cancelled", None)


def validate_schema(df: DataFrame) -> tuple[DataFrame, bool]:
    """Accept ``Customer ID`` for ``CustomerID``; the flag tells whether all columns are there."""
    if "Customer ID" in df.columns and "CustomerID" not in df.columns:
        df = df.withColumnRenamed("Customer ID", "CustomerID")
    return df, set(COLUMNS) <= set(df.columns)


def require_columns(df: DataFrame, needed: set[str]) -> DataFrame:
    """``df`` with the customer column named ``CustomerID``; raises when a needed column is missing."""
    if "Customer ID" in df.columns and "CustomerID" not in df.columns:
        df = df.withColumnRenamed("Customer ID", "CustomerID")
    missing = needed - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df
