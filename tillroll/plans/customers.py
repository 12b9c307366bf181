"""Who buys, how often, how much, and until when."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.dates import month_label, month_start, whole_days
from tillroll.functions.money import big, line_revenue, percent, ratio
from tillroll.functions.rules import is_valid_sale
from tillroll.operators.ordering import global_row_number, top_rows, with_totals
from tillroll.schema import reads

_SPEND = ("Invoice", "Quantity", "Price", "CustomerID")


@reads("CustomerID")
def customers_total(tx: DataFrame) -> DataFrame:
    return tx.agg(F.countDistinct("CustomerID").alias("total_unique_customers"))


def customer_spend(tx: DataFrame) -> DataFrame:
    """Exact spend and order count per customer over valid sales."""
    return (
        tx.where(is_valid_sale())
        .groupBy("CustomerID")
        .agg(F.sum(line_revenue()).alias("spend"), F.countDistinct("Invoice").alias("orders"))
    )


@reads(*_SPEND, "Country", cancelled=False)
def customers_top_spend(tx: DataFrame, k: int = 20) -> DataFrame:
    """Best customers with their rank; of several countries the first by name is shown."""
    invoices = (
        tx.where(is_valid_sale())
        .groupBy("CustomerID", "Country", "Invoice")
        .agg(F.sum(line_revenue()).alias("revenue"))
    )
    # the minimum over text runs on invoices, not on lines
    stats = invoices.groupBy("CustomerID").agg(
        F.min("Country").alias("Country"),
        F.sum("revenue").alias("spend"),
        F.countDistinct("Invoice").alias("total_orders"),
    )
    best = top_rows(stats, [F.desc("spend"), F.asc("CustomerID")], k)
    return best.select(
        "CustomerID",
        "Country",
        F.col("spend").cast("double").alias("total_spend"),
        "total_orders",
        # only rows above a row count for its rank, so the first k rows suffice
        big(F.rank().over(Window.orderBy(F.desc("spend")))).alias("customer_spend_rank"),
    )


@reads("Invoice", "CustomerID")
def customers_frequency_dist(tx: DataFrame, k: int = 15) -> DataFrame:
    """Customers per order count, as a share of all customers, those without a valid sale included."""
    orders = F.countDistinct(F.when(is_valid_sale(), F.col("Invoice")))
    histogram = (
        tx.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(orders.alias("order_count"))
        .groupBy("order_count")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # order counts are few: n different ones need at least n * n / 2 orders
    everyone = F.sum("customers").over(Window.partitionBy())
    shares = histogram.select(
        "order_count",
        F.col("customers").alias("customer_count"),
        percent(F.col("customers"), everyone).alias("customer_percentage"),
    )
    return top_rows(shares.where(F.col("order_count") > 0), [F.asc("order_count")], k)


@reads(*_SPEND)
def customers_aov(tx: DataFrame, k: int = 10) -> DataFrame:
    values = customer_spend(tx).select(
        "CustomerID",
        ratio(F.col("spend"), F.col("orders")).alias("avg_order_value"),
        F.col("orders").alias("order_count"),
    )
    return top_rows(values, [F.desc("avg_order_value"), F.asc("CustomerID")], k)


@reads("Invoice", "CustomerID", cancelled=False)
def customers_repeat_rate(tx: DataFrame) -> DataFrame:
    orders = (
        tx.where(is_valid_sale()).groupBy("CustomerID").agg(F.countDistinct("Invoice").alias("orders"))
    )
    repeat = F.count(F.when(F.col("orders") > 1, 1))
    return orders.agg(
        repeat.alias("repeat_customers"),
        F.count(F.lit(1)).alias("total_customers"),
        percent(repeat, F.count(F.lit(1))).alias("repeat_purchase_rate_pct"),
    )


@reads("Invoice", "InvoiceDate", "CustomerID", cancelled=False)
def customers_cohorts(tx: DataFrame) -> DataFrame:
    """Customers active per month, by the month of their first purchase.

    The lines shrink to one row per customer and month before the window, which
    then holds no more rows per customer than there are months.
    """
    active = (
        tx.where(is_valid_sale())
        .groupBy("CustomerID", month_start(F.col("InvoiceDate")).alias("activity_month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min("activity_month").over(Window.partitionBy("CustomerID"))
    return (
        active.withColumn("cohort_month", first)
        .groupBy("cohort_month", "activity_month")
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .withColumns({c: month_label(F.col(c)) for c in ("cohort_month", "activity_month")})
        .orderBy("cohort_month", "activity_month")
    )


@reads("Invoice", "InvoiceDate", "CustomerID", cancelled=False)
def customers_lifetime(tx: DataFrame, k: int = 10) -> DataFrame:
    span = (
        tx.where(is_valid_sale())
        .groupBy("CustomerID")
        .agg(F.min("InvoiceDate").alias("first_purchase"), F.max("InvoiceDate").alias("last_purchase"))
        .withColumn("customer_lifetime_days", whole_days(F.col("first_purchase"), F.col("last_purchase")))
    )
    return top_rows(span, [F.desc("customer_lifetime_days"), F.asc("CustomerID")], k)


@reads("Invoice", "InvoiceDate", "CustomerID")
def customers_active(tx: DataFrame, days: int = 90) -> DataFrame:
    """Customers by recency against the last date of the whole table.

    The shares are of all customers, cancel-only ones included, and so need not add up to 100.
    """
    customers = tx.groupBy("CustomerID").agg(
        F.max(F.when(is_valid_sale(), F.col("InvoiceDate"))).alias("last_sale"),
    )
    dated = with_totals(
        customers, tx, newest=F.max("InvoiceDate"), everyone=F.countDistinct("CustomerID")
    ).where(F.col("last_sale").isNotNull())
    recent = whole_days(F.col("last_sale"), F.col("newest")) <= days
    status = F.when(recent, f"Active (<= {days} days)").otherwise(f"Inactive (> {days} days)")
    return (
        dated.groupBy(status.alias("customer_status"))
        .agg(F.count(F.lit(1)).alias("customer_count"), F.max("everyone").alias("everyone"))
        .select(
            "customer_status",
            "customer_count",
            percent(F.col("customer_count"), F.col("everyone")).alias("pct"),
        )
    )


@reads(*_SPEND)
def customers_pareto(tx: DataFrame) -> DataFrame:
    """Revenue of the top fifth of customers.

    The fifth is of all customers; only those with a valid sale are ranked.
    """
    sale = is_valid_sale()
    spend = (
        tx.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.sum(F.when(sale, line_revenue())).alias("spend"),
            F.count(F.when(sale, 1)).alias("sales"),
        )
        .withColumn("ranked", F.col("sales") > 0)
    )
    placed = global_row_number(
        spend.drop("sales"),
        [F.desc("ranked"), F.desc("spend"), F.asc("CustomerID")],
        rank="place",
        rows="everyone",
    ).where("ranked")
    top = F.col("place") * 5 <= F.col("everyone")
    tiers = placed.groupBy(F.when(top, "Top 20%").otherwise("Bottom 80%").alias("customer_tier")).agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("spend").alias("tier_spend")
    )
    # two rows
    everything = F.sum("tier_spend").over(Window.partitionBy())
    return tiers.select(
        "customer_tier",
        "customer_count",
        F.col("tier_spend").cast("double").alias("total_tier_spend"),
        percent(F.col("tier_spend"), everything).alias("contribution_percentage"),
    )
