"""Trends, purchase rhythm, baskets and cross-selling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.dates import micros, quarter_label, quarter_start, year_label
from tillroll.functions.money import line_revenue, mean, percent, ratio, rounded, total
from tillroll.functions.rules import basket_size, is_cancelled, is_valid_sale
from tillroll.operators.ordering import top_rows, with_totals
from tillroll.plans.revenue import months
from tillroll.schema import reads

_MONTHLY = ("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID")
MICROS_PER_DAY = 86_400_000_000


@reads(*_MONTHLY, cancelled=False)
def adv_rolling_3m(tx: DataFrame) -> DataFrame:
    """Mean and sum over this and the two months before that have sales."""
    # month rows only: one partition is enough
    last3 = Window.orderBy("year_month").rowsBetween(-2, Window.currentRow)
    revenue = F.col("revenue")
    return months(tx).select(
        "year_month",
        revenue.cast("double").alias("revenue"),
        ratio(F.sum(revenue).over(last3), F.count(revenue).over(last3)).alias("rolling_3month_avg_revenue"),
        F.sum(revenue).over(last3).cast("double").alias("rolling_3month_total_revenue"),
    )


@reads(*_MONTHLY, cancelled=False)
def adv_mom_growth(tx: DataFrame) -> DataFrame:
    previous = F.lag("revenue").over(Window.orderBy("year_month"))
    grown = months(tx).withColumn("previous", previous)
    return grown.select(
        "year_month",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("previous").cast("double").alias("prev_month_revenue"),
        percent(F.col("revenue") - F.col("previous"), F.col("previous")).alias("mom_growth_percentage"),
    )


@reads("Invoice", "InvoiceDate", "CustomerID", cancelled=False)
def adv_purchase_gaps(tx: DataFrame, k: int = 15) -> DataFrame:
    """Mean days between consecutive purchase times of a customer.

    The gaps between consecutive times add up to last minus first, so neither a
    sort nor a window is needed. An invoice with two times counts twice.
    """
    purchases = (
        tx.where(is_valid_sale())
        .groupBy("CustomerID", "Invoice", "InvoiceDate")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    gaps = F.count("InvoiceDate") - 1
    span = micros(F.max("InvoiceDate")) - micros(F.min("InvoiceDate"))
    rhythm = purchases.groupBy("CustomerID").agg(gaps.alias("repeat_purchase_count"), span.alias("span"))
    days = ratio(F.col("span"), F.col("repeat_purchase_count")) / MICROS_PER_DAY
    shown = rhythm.where(F.col("repeat_purchase_count") > 0).select(
        "CustomerID", "repeat_purchase_count", rounded(days, 1).alias("avg_days_between_purchases")
    )
    return top_rows(shown, [F.asc("avg_days_between_purchases"), F.asc("CustomerID")], k)


@reads("Invoice", "Quantity", "Price", "CustomerID", "Country", cancelled=False)
def adv_country_cumulative(tx: DataFrame) -> DataFrame:
    countries = tx.where(is_valid_sale()).groupBy("Country").agg(F.sum(line_revenue()).alias("revenue"))
    # country rows only; the default frame lets equal revenues share a total
    running = F.sum("revenue").over(Window.orderBy(F.desc("revenue")))
    everything = F.sum("revenue").over(Window.partitionBy())
    return (
        countries.select(
            "Country",
            F.col("revenue").cast("double").alias("total_revenue"),
            running.cast("double").alias("cumulative_running_revenue"),
            percent(F.col("revenue"), everything).alias("revenue_share_pct"),
        )
        .orderBy(F.desc("total_revenue"), "Country")
    )


@reads("Invoice", "StockCode", "Description", "Quantity", "CustomerID", cancelled=False)
def adv_top_product_per_customer(tx: DataFrame, k: int = 15) -> DataFrame:
    # a customer's lines of one product are few: nothing to sum up before the minimum over text
    bought = tx.where(is_valid_sale()).groupBy("CustomerID", "StockCode").agg(
        F.sum("Quantity").alias("total_quantity"), F.min("Description").alias("product_name")
    )
    place = F.row_number().over(
        Window.partitionBy("CustomerID").orderBy(F.desc("total_quantity"), F.asc("StockCode"))
    )
    favourites = bought.withColumn("place", place).where(F.col("place") == 1)
    return top_rows(favourites, [F.desc("total_quantity"), F.asc("CustomerID")], k).select(
        "CustomerID", "StockCode", "product_name", "total_quantity"
    )


@reads("Invoice", "Quantity", "Price", cancelled=False)
def adv_basket_sizes(tx: DataFrame) -> DataFrame:
    baskets = (
        tx.where(~is_cancelled())
        .groupBy("Invoice")
        .agg(F.sum("Quantity").alias("units"), F.sum(line_revenue()).alias("revenue"))
    )
    return (
        baskets.groupBy(basket_size(F.col("units")).alias("basket_size_category"))
        .agg(
            F.count("Invoice").alias("invoice_count"),
            rounded(mean(F.col("revenue")), 2).alias("avg_basket_value"),
        )
        .orderBy("basket_size_category")
    )


def _buyers(tx: DataFrame, bought: str, missing: str) -> DataFrame:
    """Per customer, the NULL one included: whether either product was ever bought. One pass, one shuffle."""
    code = F.col("StockCode")
    return (
        tx.where(code.isin(bought, missing))
        .groupBy("CustomerID")
        .agg(
            F.max(code == bought).alias("has"),
            F.max(code == missing).alias("has_other"),
        )
    )


def _first_customers(customers: DataFrame, k: int | None) -> DataFrame:
    return customers if k is None else top_rows(customers, [F.asc("CustomerID")], k)


@reads("StockCode", "CustomerID")
def cross_sell(tx: DataFrame, bought: str = "85123A", missing: str = "84029E", k: int | None = 15) -> DataFrame:
    """Customers who bought one product and never the other: the first ``k`` of them, or all, in no order, if ``k`` is None."""
    prospects = _buyers(tx, bought, missing).where(
        F.col("CustomerID").isNotNull() & F.col("has") & ~F.col("has_other")
    )
    return _first_customers(prospects.select("CustomerID"), k)


@reads("StockCode", "CustomerID")
def cross_sell_strict(tx: DataFrame, bought: str = "85123A", missing: str = "84029E", k: int | None = 15) -> DataFrame:
    """The same under the literal NOT IN rule: one guest purchase of the other product empties the result.

    Guests are counted apart; Spark would broadcast the whole list of a NOT IN.
    """
    who = F.col("CustomerID")
    others = tx.where(F.col("StockCode") == missing)
    flagged = with_totals(_buyers(tx, bought, missing), others, guests=F.count(F.when(who.isNull(), 1)))
    prospects = flagged.where((F.col("guests") == 0) & who.isNotNull() & F.col("has") & ~F.col("has_other"))
    return _first_customers(prospects.select("CustomerID"), k)


@reads("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID", cancelled=False)
def adv_quarterly(tx: DataFrame) -> DataFrame:
    day = F.col("quarter_start")
    return (
        tx.where(is_valid_sale())
        .groupBy(quarter_start(F.col("InvoiceDate")).alias("quarter_start"))
        .agg(
            total(line_revenue()).alias("quarterly_revenue"),
            F.countDistinct("Invoice").alias("order_count"),
        )
        .select(
            year_label(day).alias("sales_year"),
            quarter_label(day).alias("quarter"),
            "quarterly_revenue",
            "order_count",
        )
        .orderBy("sales_year", "quarter")
    )
