"""Cleaning of transaction lines: ten steps in a fixed order, and an audit of the rows each one drops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.functions.money import percent
from tillroll.functions.rules import is_cancelled
from tillroll.operators.quantiles import quantile_row
from tillroll.schema import COLUMNS
from tillroll.staging import written

# Stock codes that are services, fees or tests.
SERVICE_CODES = ["POST", "D", "DOT", "M", "BANK CHARGES", "TEST", "PADS", "ADJUST", "CRUK"]

PRICE_SCALE = 2


def _decimals(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else 0


def _true(condition: Column) -> Column:
    """A comparison with NULL counts as not met."""
    return F.coalesce(condition, F.lit(False))


def has_customer() -> Column:
    return F.col("CustomerID").isNotNull()


def is_service(code: Column) -> Column:
    return _true(F.upper(code).isin(SERVICE_CODES))


def is_test(customer: Column, code: Column) -> Column:
    return ~_true(customer.rlike("^[0-9]+$")) | is_service(code)


def clean_missing_customer(tx: DataFrame) -> DataFrame:
    return tx.where(has_customer())


def clean_cancelled(tx: DataFrame) -> DataFrame:
    trimmed = tx.withColumn("Invoice", F.trim("Invoice"))
    return trimmed.where(~_true(is_cancelled()))


def clean_quantity(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("Quantity") > 0)


def clean_price(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("Price") > 0)


def clean_types(tx: DataFrame) -> DataFrame:
    """Customer ids such as '13085.0' lose their decimals."""
    return tx.withColumns({
        "InvoiceDate": F.col("InvoiceDate").cast("timestamp_ntz"),
        "CustomerID": F.trim(F.substring_index(F.col("CustomerID").cast("string"), ".", 1)),
        "Quantity": F.col("Quantity").cast("int"),
        "Price": F.col("Price").cast("decimal(12,2)"),
    })


def clean_duplicates(tx: DataFrame) -> DataFrame:
    return tx.dropDuplicates()


def clean_test_accounts(tx: DataFrame) -> DataFrame:
    return tx.where(~is_test(F.col("CustomerID"), F.col("StockCode")))


_LINE_STEPS = [
    clean_missing_customer,
    clean_cancelled,
    clean_quantity,
    clean_price,
    clean_types,
    clean_duplicates,
    clean_test_accounts,
]


def clean_lines(tx: DataFrame, unique: bool = False) -> DataFrame:
    """The steps that drop rows. Duplicates are found on typed rows; ``unique`` says that the lines kept hold none."""
    steps = [s for s in _LINE_STEPS if not (unique and s is clean_duplicates)]
    return reduce(DataFrame.transform, steps, tx)


def clip_bounds(lines: DataFrame, lower_pct: float = 0.01, upper_pct: float = 0.99) -> DataFrame:
    """One row with the exact quantiles of quantity and price."""
    return quantile_row(lines, {
        "quantity_low": ("Quantity", lower_pct),
        "quantity_high": ("Quantity", upper_pct),
        "price_low": ("Price", lower_pct),
        "price_high": ("Price", upper_pct),
    })


def clip(lines: DataFrame, bounds: DataFrame) -> DataFrame:
    """Quantity and price held within one row of bounds."""

    # the bounds have the decimals that hold them exactly
    scale = max(_decimals(bounds, c) for c in bounds.columns)
    clipped = f"decimal({12 + scale},{scale})"

    def held(column: str, low: str, high: str) -> Column:
        inside = F.greatest(F.col(column).cast(clipped), F.col(low).cast(clipped))
        capped = F.least(inside, F.col(high).cast(clipped))
        return F.when(F.col(column).isNotNull(), capped)

    return (
        lines.crossJoin(F.broadcast(bounds))
        .withColumns({
            "Quantity": held("Quantity", "quantity_low", "quantity_high"),
            "Price": held("Price", "price_low", "price_high"),
        })
        .drop(*bounds.columns)
    )


def winsorize(lines: DataFrame, lower_pct: float = 0.01, upper_pct: float = 0.99) -> DataFrame:
    return clip(lines, clip_bounds(lines, lower_pct, upper_pct))


def clean_description(tx: DataFrame) -> DataFrame:
    """Runs after the duplicates are gone, so rows that differ in case both stay. NULL stays NULL."""
    return tx.withColumn("Description", F.upper(F.trim("Description")))


def add_revenue(tx: DataFrame) -> DataFrame:
    # a clipped quantity has the decimals of its percentile, a clipped price two more; their product has both
    scale = max(6, 2 * _decimals(tx, "Price") - PRICE_SCALE)
    return tx.withColumn("Revenue", (F.col("Quantity") * F.col("Price")).cast(f"decimal({min(38, 18 + scale)},{scale})"))


def finish(lines: DataFrame, bounds: DataFrame) -> DataFrame:
    return add_revenue(clean_description(clip(lines, bounds)))


def clean_all(tx: DataFrame, lower_pct: float = 0.01, upper_pct: float = 0.99) -> DataFrame:
    """All steps. The kept lines are written once and read for the bounds and for the result."""
    lines = written(clean_lines(tx), "lines")
    return finish(lines, clip_bounds(lines, lower_pct, upper_pct))


# The audited steps.
AUDITED = [
    "Remove Missing Customer ID",
    "Remove Cancelled Transactions",
    "Remove Non-Positive Quantities",
    "Remove Non-Positive Prices",
    "Remove Duplicates",
    "Remove Test Accounts & Codes",
]


def cleaning_report(tx: DataFrame) -> DataFrame:
    """Rows before and after each dropping step, in one pass.

    A row is marked with the first of the four row rules it breaks. Rows that
    break one are counted per rule; the others are grouped on all their columns,
    which gives the count with and without duplicates.
    """
    invoice = F.trim("Invoice")
    keeps = [
        has_customer(),
        ~_true(F.startswith(invoice, F.lit("C"))),
        _true(F.col("Quantity") > 0),
        _true(F.col("Price") > 0),
    ]
    broken = F.coalesce(*[F.when(~k, F.lit(i)) for i, k in enumerate(keeps, 1)], F.lit(0))
    typed = clean_types(tx.withColumn("broken", broken).withColumn("Invoice", invoice))
    kept = F.col("broken") == 0
    groups = (
        typed.select("broken", *[F.when(kept, F.col(c)).alias(c) for c in COLUMNS])
        .groupBy("broken", *COLUMNS)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    test = is_test(F.col("CustomerID"), F.col("StockCode"))
    zero = F.lit(0).cast("bigint")
    counts = groups.agg(
        *[F.coalesce(F.sum(F.when(F.col("broken") == i, F.col("n"))), zero).alias(f"gone{i}") for i in range(1, 5)],
        F.coalesce(F.sum(F.when(kept, F.col("n") - 1)), zero).alias("gone5"),
        F.count(F.when(kept & test, 1)).alias("gone6"),
        F.coalesce(F.sum("n"), zero).alias("original"),
    )

    def removed_by(steps: int) -> Column:
        return sum((F.col(f"gone{i}") for i in range(1, steps + 1)), zero)

    rows = F.array(*[
        F.struct(
            F.lit(name).alias("step_name"),
            (F.col("original") - removed_by(i)).alias("rows_before"),
            (F.col("original") - removed_by(i + 1)).alias("rows_after"),
            F.col(f"gone{i + 1}").alias("rows_removed"),
            removed_by(i + 1).alias("total_removed"),
            F.col("original").alias("original"),
        )
        for i, name in enumerate(AUDITED)
    ])
    return counts.select(F.inline(rows)).select(
        "step_name",
        "rows_before",
        "rows_after",
        "rows_removed",
        F.coalesce(percent(F.col("rows_removed"), F.col("rows_before"), 4), F.lit(0.0)).alias("pct_removed"),
        "total_removed",
        F.coalesce(percent(F.col("total_removed"), F.col("original")), F.lit(0.0)).alias("total_removed_pct"),
    )
