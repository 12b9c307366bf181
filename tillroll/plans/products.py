"""What sells, what comes back, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.money import line_revenue, ratio, rounded, total
from tillroll.functions.rules import is_abroad, is_cancelled, is_priced
from tillroll.operators.ordering import top_rows
from tillroll.schema import reads


def per_product(sales: DataFrame, by: list[str], name: str, **sums: Column) -> DataFrame:
    """Sums per product with its first description by name.

    A minimum over text cannot be hash-aggregated. So the lines are first summed
    with the description in the key; the minimum runs on the few rows left.
    """
    base = sales.groupBy(*by, "Description").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return base.groupBy(*by).agg(F.min("Description").alias(name), *[F.sum(n).alias(n) for n in sums])


_SALES = ("Invoice", "StockCode", "Description", "Quantity", "Price")


@reads(*_SALES, cancelled=False)
def products_top_revenue(tx: DataFrame, k: int = 20) -> DataFrame:
    # the distinct invoices per product are nearly the lines: nothing to sum up first
    stats = tx.where(~is_cancelled() & is_priced()).groupBy("StockCode").agg(
        F.min("Description").alias("Description"),
        total(line_revenue()).alias("total_revenue"),
        F.sum("Quantity").alias("units_sold"),
        F.countDistinct("Invoice").alias("order_count"),
    )
    return top_rows(stats, [F.desc("total_revenue"), F.asc("StockCode")], k)


@reads(*_SALES, cancelled=False)
def products_top_units(tx: DataFrame, k: int = 20) -> DataFrame:
    sales = tx.where(~is_cancelled() & is_priced())
    stats = per_product(
        sales, ["StockCode"], "Description", units_sold=F.col("Quantity"), total_revenue=line_revenue()
    ).withColumn("total_revenue", F.col("total_revenue").cast("double"))
    return top_rows(stats, [F.desc("units_sold"), F.asc("StockCode")], k)


@reads(*_SALES, cancelled=True)
def products_most_returned(tx: DataFrame, k: int = 20) -> DataFrame:
    stats = tx.where(is_cancelled()).groupBy("StockCode").agg(
        F.min("Description").alias("Description"),
        F.abs(F.sum("Quantity")).alias("returned_units"),
        F.abs(F.sum(line_revenue())).cast("double").alias("refunded_amount"),
        F.countDistinct("Invoice").alias("return_count"),
    )
    return top_rows(stats, [F.desc("returned_units"), F.asc("StockCode")], k)


@reads("StockCode", "Description", "Price")
def products_price_stats(tx: DataFrame, k: int = 10) -> DataFrame:
    price = F.col("Price")
    stats = (
        tx.where(is_priced())
        .groupBy("StockCode", "Description")
        .agg(F.sum(price).alias("sum"), F.count(price).alias("n"), F.min(price).alias("low"), F.max(price).alias("high"))
        .groupBy("StockCode")
        .agg(
            F.min("Description").alias("Description"),
            ratio(F.sum("sum"), F.sum("n")).alias("avg_price"),
            F.min("low").cast("double").alias("min_price"),
            F.max("high").cast("double").alias("max_price"),
        )
    )
    return top_rows(stats, [F.desc("avg_price"), F.asc("StockCode")], k)


@reads("StockCode", "Quantity", "CustomerID")
def products_diversity(tx: DataFrame, k: int = 15) -> DataFrame:
    stats = (
        tx.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.countDistinct("StockCode").alias("unique_products_bought"),
            F.sum("Quantity").alias("total_units_bought"),
        )
    )
    return top_rows(stats, [F.desc("unique_products_bought"), F.asc("CustomerID")], k)


@reads("StockCode", "Description", "CustomerID")
def products_single_buyer(tx: DataFrame, buyers: int = 1, k: int = 10) -> DataFrame:
    """Products with exactly ``buyers`` known customers."""
    stats = tx.where(F.col("CustomerID").isNotNull()).groupBy("StockCode").agg(
        F.min("Description").alias("product_name"), F.countDistinct("CustomerID").alias("unique_buyer_count")
    )
    return top_rows(stats.where(F.col("unique_buyer_count") == buyers), [F.asc("StockCode")], k)


@reads("Invoice", "StockCode", "Description", "Quantity", "Country", cancelled=False)
def products_best_by_country(tx: DataFrame, k: int = 15) -> DataFrame:
    """Best seller of each foreign country, then the strongest of those."""
    sales = tx.where(~is_cancelled() & is_abroad())
    stats = per_product(sales, ["Country", "StockCode"], "Description", total_quantity=F.col("Quantity"))
    # Spark keeps only each task's best row per country before the shuffle (window group limit)
    place = F.row_number().over(
        Window.partitionBy("Country").orderBy(F.desc("total_quantity"), F.asc("StockCode"))
    )
    best = stats.withColumn("place", place).where(F.col("place") == 1).drop("place")
    return top_rows(best, [F.desc("total_quantity"), F.asc("Country")], k)


def sold_and_returned() -> dict[str, Column]:
    units = F.col("Quantity")
    return {
        "sold_qty": F.when(units > 0, units).otherwise(0),
        "returned_qty": F.when(units < 0, F.abs(units)).otherwise(0),
    }


def return_rate() -> Column:
    """Returned per sold units in percent; the tiny addend keeps products never sold finite."""
    sold = F.col("sold_qty").cast("double") + F.lit(1e-5)
    return rounded(F.col("returned_qty").cast("double") * 100 / sold, 2)


@reads("StockCode", "Description", "Quantity")
def products_return_rate(tx: DataFrame, min_sold: int = 100, k: int = 10) -> DataFrame:
    rates = (
        per_product(tx, ["StockCode"], "product_name", **sold_and_returned())
        .where(F.col("sold_qty") > min_sold)
        .withColumn("return_rate_pct", return_rate())
    )
    return top_rows(rates, [F.desc("return_rate_pct"), F.asc("StockCode")], k)
