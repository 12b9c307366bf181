"""The four reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.dates import month_label, month_of_year, month_start, year_label
from tillroll.functions.money import line_revenue, mean, ratio, total
from tillroll.functions.rules import is_priced, is_valid_sale
from tillroll.plans.products import return_rate, sold_and_returned
from tillroll.plans.rfm import RFM_INPUT, segments_sql
from tillroll.schema import reads


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", "Country", cancelled=False)
def v_customer_summary(tx: DataFrame) -> DataFrame:
    """Per customer and country."""
    orders = F.countDistinct("Invoice")
    return (
        tx.where(is_valid_sale())
        .groupBy("CustomerID", "Country")
        .agg(
            F.min("InvoiceDate").alias("first_purchase_date"),
            F.max("InvoiceDate").alias("last_purchase_date"),
            orders.alias("total_orders"),
            F.sum("Quantity").alias("total_items_bought"),
            total(line_revenue()).alias("total_revenue_spend"),
            mean(line_revenue()).alias("avg_item_revenue"),
            ratio(F.sum(line_revenue()), orders).alias("avg_order_value"),
        )
    )


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def v_monthly_revenue(tx: DataFrame) -> DataFrame:
    month = F.col("month")
    return (
        tx.where(is_valid_sale())
        .groupBy(month_start(F.col("InvoiceDate")).alias("month"))
        .agg(
            total(line_revenue()).alias("net_revenue"),
            F.countDistinct("Invoice").alias("total_orders"),
            F.countDistinct("CustomerID").alias("active_customers"),
        )
        .select(
            year_label(month).alias("sales_year"),
            month_of_year(month).alias("sales_month"),
            month_label(month).alias("year_month"),
            "net_revenue",
            "total_orders",
            "active_customers",
        )
    )


@reads(*RFM_INPUT)
def v_rfm_segments(tx: DataFrame) -> DataFrame:
    scored = segments_sql(tx)
    return scored.select(
        "CustomerID",
        "Recency",
        "Frequency",
        F.col("Monetary").cast("double").alias("Monetary"),
        F.col("R_Score").alias("r_score"),
        F.col("F_Score").alias("f_score"),
        F.col("M_Score").alias("m_score"),
        F.col("RFM_Score").alias("rfm_score"),
        "Segment",
    )


@reads("StockCode", "Description", "Quantity", "Price", "CustomerID")
def v_product_summary(tx: DataFrame) -> DataFrame:
    """Per product."""
    lines = tx.where(is_priced()).withColumn("r", line_revenue())
    units, revenue = F.col("Quantity"), F.col("r")
    stats = lines.groupBy("StockCode").agg(
        F.min("Description").alias("product_description"),
        *[F.sum(c).alias(n) for n, c in sold_and_returned().items()],
        F.sum(F.when(units > 0, revenue).otherwise(0)).alias("gross"),
        F.sum(F.when(units < 0, F.abs(revenue)).otherwise(0)).alias("refunds"),
        F.countDistinct("CustomerID").alias("unique_buyers"),
    )
    return stats.select(
        "StockCode",
        "product_description",
        F.col("sold_qty").alias("units_sold"),
        F.col("gross").cast("double").alias("gross_sales_value"),
        F.col("returned_qty").alias("units_returned"),
        F.col("refunds").cast("double").alias("refunds_value"),
        (F.col("gross") - F.col("refunds")).cast("double").alias("net_sales_value"),
        "unique_buyers",
        return_rate().alias("return_rate_pct"),
    )


VIEWS = {
    "v_customer_summary": v_customer_summary,
    "v_monthly_revenue": v_monthly_revenue,
    "v_rfm_segments": v_rfm_segments,
    "v_product_summary": v_product_summary,
}


def create_views(tx: DataFrame) -> list[str]:
    """Register all four as temporary views, replacing older ones."""
    for name, build in VIEWS.items():
        build(tx).createOrReplaceTempView(name)
    return sorted(VIEWS)
