"""Business measures and the star schema they run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.dates import (
    month_label,
    month_of_year,
    month_start,
    quarter_label,
    whole_days,
    year_label,
    year_start,
)
from tillroll.functions.money import mean, ratio
from tillroll.operators.ordering import with_totals

ASSUMED_CAC = 45.0
CHURN_DAYS = 90


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def net_sales() -> Column:
    return F.sum("Revenue").cast("double")


def customers() -> Column:
    return F.countDistinct("CustomerID")


def orders() -> Column:
    return F.countDistinct("Invoice")


def average_order_value() -> Column:
    return _or_zero(ratio(F.sum("Revenue"), orders()))


def purchase_frequency() -> Column:
    return _or_zero(ratio(orders(), customers()))


# Measure name -> column over cleaned lines, for any grouping.
MEASURES = {
    "net_sales": net_sales,
    "unique_customers": customers,
    "total_orders": orders,
    "average_order_value": average_order_value,
    "purchase_frequency": purchase_frequency,
}


def kpi(fact: DataFrame, *names: str) -> DataFrame:
    return fact.agg(*[MEASURES[n]().alias(n) for n in names])


def kpi_by(
    fact: DataFrame, by: list[str], names: list[str] | None = None, customers: DataFrame | None = None, cac: float = ASSUMED_CAC
) -> DataFrame:
    """Any measures under any grouping; with ``customers`` (see ``customer_facts``) all eleven.

    Lines are first summed per group, invoice and customer, so that the distinct
    counts run on invoices instead of lines. The measures of customers are over
    those who bought in the group: the repeat rate counts their invoices of the
    group, days and predictions are those of the customer as a whole.
    """
    invoices = fact.groupBy(*by, "Invoice", "CustomerID").agg(F.sum("Revenue").alias("Revenue"))
    sums = invoices.groupBy(*by).agg(*[MEASURES[n]().alias(n) for n in names or MEASURES])
    if customers is None:
        return sums
    members = invoices.groupBy(*by, "CustomerID").agg(F.count(F.lit(1)).alias("orders")).join(customers, "CustomerID", "left")
    everyone = F.count(F.lit(1))
    value = F.col("predicted_cltv").cast("decimal(28,6)")
    of_customers = members.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.lit(cac).alias("assumed_cac"),
        F.sum(value).cast("double").alias("total_predicted_cltv"),
        mean(value).alias("avg_predicted_cltv"),
        _or_zero(ratio(mean(value), F.lit(cac))).alias("ltv_to_cac"),
        _or_zero(ratio(F.count(F.when(F.col("orders") > 1, 1)), everyone)).alias("repeat_purchase_rate"),
        _or_zero(ratio(F.count(F.when(F.col("DaysSinceLastPurchase") > CHURN_DAYS, 1)), everyone)).alias("churn_rate"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return sums.join(of_customers, same).drop(*[f"_{c}" for c in by])


def customer_facts(fact: DataFrame, scored: DataFrame) -> DataFrame:
    """Per customer: days since the last purchase and the predicted value, for ``kpi_by``."""
    return days_since_last_purchase(fact).join(scored.select("CustomerID", "predicted_cltv"), "CustomerID", "left")


def with_dimensions(fact: DataFrame, segments: DataFrame) -> DataFrame:
    """Lines with the columns of the star's dimensions: segment, year and quarter beside country and product."""
    day = F.col("InvoiceDate")
    dated = fact.withColumns({"Year": year_label(day), "Quarter": quarter_label(day)})
    return dated.join(segments.select("CustomerID", "Segment"), "CustomerID", "left")


def kpi_repeat_rate(fact: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("CustomerID").agg(F.countDistinct("Invoice").alias("orders"))
    repeat = F.count(F.when(F.col("orders") > 1, 1))
    return per_customer.agg(_or_zero(ratio(repeat, F.count(F.lit(1)))).alias("repeat_purchase_rate"))


def days_since_last_purchase(fact: DataFrame) -> DataFrame:
    """Per customer, whole days to the newest line."""
    last = fact.groupBy("CustomerID").agg(F.max("InvoiceDate").alias("last"))
    dated = with_totals(last, fact, newest=F.max("InvoiceDate"))
    days = whole_days(F.col("last"), F.col("newest"))
    return dated.select("CustomerID", days.alias("DaysSinceLastPurchase"))


def kpi_churn_rate(fact: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    gone = F.count(F.when(F.col("DaysSinceLastPurchase") > days, 1))
    return days_since_last_purchase(fact).agg(
        _or_zero(ratio(gone, F.count(F.lit(1)))).alias("churn_rate")
    )


def kpi_cac(fact: DataFrame, cac: float = ASSUMED_CAC) -> DataFrame:
    """The assumed acquisition cost per customer, and what it makes for all of them."""
    return fact.agg(
        F.lit(cac).alias("assumed_cac"), (customers() * F.lit(cac)).alias("acquisition_spend")
    )


def kpi_predicted(scored: DataFrame) -> DataFrame:
    value = F.col("predicted_cltv").cast("decimal(28,6)")
    return scored.agg(
        F.sum(value).cast("double").alias("total_predicted_cltv"),
        mean(value).alias("avg_predicted_cltv"),
    )


def kpi_ltv_cac(scored: DataFrame, cac: float = ASSUMED_CAC, target: float = 3.0) -> DataFrame:
    average = mean(F.col("predicted_cltv").cast("decimal(28,6)"))
    return scored.agg(_or_zero(ratio(average, F.lit(cac))).alias("ltv_to_cac")).withColumn(
        "meets_target", F.col("ltv_to_cac") > target
    )


def dim_date(fact: DataFrame) -> DataFrame:
    """Every day of the years the data touches: one row per day, made from two dates."""
    span = fact.agg(
        year_start(F.min("InvoiceDate")).alias("start"),
        F.last_day(F.add_months(year_start(F.max("InvoiceDate")), 11)).alias("stop"),
    )
    day = F.col("Date")
    return span.select(F.explode(F.sequence("start", "stop")).alias("Date")).select(
        "Date",
        year_label(day).alias("Year"),
        quarter_label(day).alias("Quarter"),
        month_of_year(day).alias("Month"),
    )


def dim_customers(summary: DataFrame, segments: DataFrame) -> DataFrame:
    """Customer summary with the RFM scores where the customer has some."""
    scores = segments.select("CustomerID", "Recency", "RFM_Score", "Segment")
    return summary.join(scores, "CustomerID", "left")


def star_join(fact: DataFrame, segments: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by segment, year and quarter through the three dimensions.

    Lines are summed to customer, product and day before they meet a dimension,
    which also shrinks a customer or product with very many lines.
    """
    sales = fact.groupBy("CustomerID", "StockCode", F.col("InvoiceDate").cast("date").alias("Date")).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Quantity").alias("Quantity")
    )
    named = products.select("StockCode", F.col("product_description").isNotNull().alias("known"))
    return (
        sales.join(segments.select("CustomerID", "Segment"), "CustomerID", "left")
        .join(named, "StockCode", "left")
        .join(calendar, "Date", "left")
        .groupBy("Segment", "Year", "Quarter")
        .agg(
            F.sum("Revenue").cast("double").alias("net_sales"),
            F.sum("Quantity").cast("double").alias("units"),
            F.count(F.when(F.col("known"), 1)).alias("known_product_sales"),
        )
    )


def eda_monthly_trend(cleaned: DataFrame) -> DataFrame:
    return (
        cleaned.groupBy(month_start(F.col("InvoiceDate")).alias("month"))
        .agg(net_sales().alias("Revenue"))
        .select(month_label(F.col("month")).alias("YearMonth"), "Revenue")
        .orderBy("YearMonth")
    )


def eda_top_countries(cleaned: DataFrame, k: int = 5) -> DataFrame:
    countries = cleaned.groupBy("Country").agg(net_sales().alias("Revenue"))
    return countries.orderBy(F.desc("Revenue"), "Country").limit(k)


def kpi_overview(features: DataFrame, segments: DataFrame, scored: DataFrame) -> DataFrame:
    """Customers, historic and predicted value, and retention (recency of 90 days or less)."""
    base = features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        mean(F.col("Monetary").cast("decimal(28,6)")).alias("avg_historical_spend"),
    )
    late = F.count(F.when(F.col("Recency") > CHURN_DAYS, 1))
    history = segments.agg(
        F.sum("Monetary").cast("double").alias("total_historical_spend"),
        (F.lit(100.0) - ratio(late, F.count(F.lit(1))) * 100).alias("retention_pct"),
    )
    forecast = scored.agg(mean(F.col("predicted_cltv").cast("decimal(28,6)")).alias("avg_predicted_cltv"))
    # three single rows
    return base.crossJoin(F.broadcast(history)).crossJoin(F.broadcast(forecast))
