"""Revenue over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.dates import (
    month_label,
    month_start,
    week_label,
    week_number,
    year_label,
    year_start,
)
from tillroll.functions.money import big, line_revenue, mean, total
from tillroll.functions.rules import is_cancelled, is_priced, is_valid_sale
from tillroll.operators.ordering import top_rows
from tillroll.schema import reads


def months(tx: DataFrame) -> DataFrame:
    """Revenue per month of valid sales, still exact. Bounded by the calendar."""
    return (
        tx.where(is_valid_sale())
        .groupBy(month_start(F.col("InvoiceDate")).alias("month"))
        .agg(F.sum(line_revenue()).alias("revenue"))
        .select(month_label(F.col("month")).alias("year_month"), "revenue")
    )


@reads("Invoice", "Quantity", "Price", "CustomerID")
def revenue_totals(tx: DataFrame) -> DataFrame:
    sales = tx.where(F.col("CustomerID").isNotNull() & is_priced()).withColumn("r", line_revenue())
    return sales.agg(
        total(F.when(F.col("Quantity") > 0, F.col("r")).otherwise(0)).alias("gross_revenue"),
        total(F.when(is_cancelled(), F.col("r")).otherwise(0)).alias("refund_revenue"),
        total(F.col("r")).alias("net_revenue"),
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_monthly(tx: DataFrame) -> DataFrame:
    return (
        tx.where(is_valid_sale())
        .groupBy(month_start(F.col("InvoiceDate")).alias("month"))
        .agg(
            total(line_revenue()).alias("monthly_revenue"),
            F.countDistinct("Invoice").alias("total_orders"),
            F.countDistinct("CustomerID").alias("unique_active_customers"),
        )
        .withColumn("month", month_label(F.col("month")))
        .withColumnRenamed("month", "year_month")
        .orderBy("year_month")
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_weekly(tx: DataFrame) -> DataFrame:
    return (
        tx.where(is_valid_sale())
        .groupBy(
            year_start(F.col("InvoiceDate")).alias("year"), week_number(F.col("InvoiceDate")).alias("week")
        )
        .agg(
            total(line_revenue()).alias("weekly_revenue"),
            F.countDistinct("Invoice").alias("total_orders"),
        )
        .select(
            week_label(F.col("year"), F.col("week")).alias("year_week"), "weekly_revenue", "total_orders"
        )
        .orderBy("year_week")
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_top_months(tx: DataFrame, k: int = 10) -> DataFrame:
    best = top_rows(months(tx), [F.desc("revenue"), F.asc("year_month")], k)
    return best.select(
        "year_month",
        F.col("revenue").cast("double").alias("monthly_revenue"),
        # only rows above a row count for its rank, so the first k rows suffice
        big(F.rank().over(Window.orderBy(F.desc("revenue")))).alias("revenue_rank"),
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_yearly(tx: DataFrame) -> DataFrame:
    return (
        tx.where(is_valid_sale())
        .groupBy(year_start(F.col("InvoiceDate")).alias("year"))
        .agg(
            total(line_revenue()).alias("annual_revenue"),
            F.countDistinct("CustomerID").alias("annual_unique_customers"),
        )
        .select(year_label(F.col("year")).alias("sales_year"), "annual_revenue", "annual_unique_customers")
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_avg_daily(tx: DataFrame) -> DataFrame:
    """Mean over the days with a sale."""
    days = (
        tx.where(is_valid_sale())
        .groupBy(F.col("InvoiceDate").cast("date").alias("day"))
        .agg(F.sum(line_revenue()).alias("revenue"))
    )
    return days.agg(mean(F.col("revenue")).alias("avg_daily_revenue"))


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def revenue_quartiles(tx: DataFrame) -> DataFrame:
    by_revenue = Window.orderBy("revenue", "year_month")
    return months(tx).select(
        "year_month",
        F.col("revenue").cast("double").alias("monthly_revenue"),
        big(F.ntile(4).over(by_revenue)).alias("revenue_quartile"),
    )
