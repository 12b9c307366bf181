"""Recency, frequency and spend: scores, segments and their summary, in two flavours.

``sql``: NTILE scores over all valid sales, recency against the newest line of
the whole table, fallback segment "Lost".
``python``: quantile-cut scores over cleaned lines, recency against the day
after the newest line, fallback segment "Need Attention".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.functions.dates import whole_days
from tillroll.functions.money import big, line_revenue, percent, ratio, rounded
from tillroll.functions.rules import is_valid_sale
from tillroll.operators.cuts import rows_at
from tillroll.operators.ordering import with_totals
from tillroll.schema import reads, require_columns

RFM_INPUT = ("Invoice", "Quantity", "InvoiceDate", "Price", "CustomerID")

# Segment names and their playbook.
PLAYBOOK = [
    (
        "Champions",
        "Best customers, buy recently and buy often with high spend.",
        "Upsell premium products, reward loyalty, seek advocacy.",
        "Invite to VIP program, early access to new collections, ask for reviews.",
        "Personalized Email / Dedicated Account Manager",
    ),
    (
        "Loyal Customers",
        "Buy regularly. Responsive to promotions.",
        "Maintain engagement, cross-sell related categories.",
        "Loyalty program points acceleration, recommend companion items.",
        "Email / Push Notifications",
    ),
    (
        "Potential Loyalists",
        "Recent shoppers with moderate frequency and spend.",
        "Increase purchase frequency.",
        "Offer multi-buy discounts, discount code for next purchase within 30 days.",
        "SMS / Push Notifications",
    ),
    (
        "New Customers",
        "Bought very recently but only once.",
        "Onboard and secure the second purchase.",
        "Welcome sequence with discount, usage/styling guides, customer support follow-up.",
        "Email / In-app greetings",
    ),
    (
        "At Risk",
        "Frequent/big spenders in the past, but haven't purchased in a while.",
        "Win them back before they churn.",
        "Send renewal/re-activation discount code, ask feedback, 'We miss you' campaign.",
        "Personalized Email / Re-targeting Ads",
    ),
    (
        "Can't Lose Them",
        "Used to make massive purchases often, but inactive for a long time.",
        "Emergency reactivation.",
        "High-value direct discount, phone outreach, exclusive renewal offers.",
        "Personalized Email / Direct Call",
    ),
    (
        "Need Attention",
        "Above-average recency and frequency, but not quite loyal.",
        "Nudge into loyal status.",
        "Limited-time offers, bundle deals based on browse history.",
        "Email / Web Popups",
    ),
    (
        "About to Sleep",
        "Below-average recency, frequency and spend. Will lose them if not reactivated.",
        "Low-cost re-engagement.",
        "Share popular products list, low value coupon.",
        "Email / Push",
    ),
    (
        "Hibernating",
        "Low frequency, low spend, and inactive for a long time.",
        "Cost-effective recovery attempt.",
        "Reconstruct value proposition, send massive seasonal clearance campaign.",
        "Email",
    ),
    (
        "Lost",
        "Lowest R, F, and M scores. Churned.",
        "Minimal spend. Abandon unless high acquisition cost justifies it.",
        "Standard automated newsletter, survey on why they left.",
        "Email",
    ),
]
# Fallback segment and the spelling of one name, per flavour.
FALLBACK = {"sql": "Lost", "python": "Need Attention"}
LOST_BIG = {"sql": "Cant Lose Them", "python": "Can't Lose Them"}


def _customer_metrics(lines: DataFrame, revenue: Column, sale: Column) -> DataFrame:
    """Per customer over the lines where ``sale`` holds; recency is left open until the newest date is known."""
    return lines.groupBy("CustomerID").agg(
        F.max(F.when(sale, F.col("InvoiceDate"))).alias("bought"),
        F.countDistinct(F.when(sale, F.col("Invoice"))).alias("Frequency"),
        F.sum(F.when(sale, revenue)).alias("Monetary"),
    )


@reads(*RFM_INPUT)
def rfm_raw_sql(tx: DataFrame) -> DataFrame:
    """Metrics over valid sales; the newest date is of the whole table, guests and cancellations included."""
    metrics = _customer_metrics(tx, line_revenue(), is_valid_sale())
    dated = with_totals(metrics, tx, newest=F.max("InvoiceDate")).where(F.col("bought").isNotNull())
    return dated.select(
        "CustomerID", whole_days(F.col("bought"), F.col("newest")).alias("Recency"), "Frequency", "Monetary"
    )


def rfm_base_full(cleaned: DataFrame) -> DataFrame:
    """Metrics over cleaned lines, recency against one day after the newest."""
    metrics = _customer_metrics(cleaned, F.col("Revenue"), F.lit(True))
    dated = with_totals(metrics, cleaned, newest=F.max("InvoiceDate"))
    reference = F.col("newest") + F.expr("interval 1 day")
    return dated.select(
        "CustomerID", whole_days(F.col("bought"), reference).alias("Recency"), "Frequency", "Monetary"
    )


def validate_rfm_input(df: DataFrame) -> DataFrame:
    return require_columns(df, {"CustomerID", "Recency", "Frequency", "Monetary"})


_METRIC = "decimal(38,10)"


def rfm_scores(rfm: DataFrame, flavour: str = "python", n_quantiles: int = 5) -> DataFrame:
    """R, F and M scores from 1 to ``n_quantiles``; equal values are told apart by the customer id.

    The ends of the quantiles are found inside the plan and broadcast, and all customers are labelled in one pass. No
    table is written, so a view of the scores follows its lines.
    """
    scored = validate_rfm_input(rfm)
    names = ["Recency", "Frequency", "Monetary"]
    # in the SQL flavour oldest first, so that recent customers land in the high tiles
    signs = {"Recency": -1 if flavour == "sql" else 1, "Frequency": 1, "Monetary": 1}
    metrics = scored.select("CustomerID", *[(F.col(n) * signs[n]).cast(_METRIC).alias(f"_{n}") for n in names])
    k, rows = F.sequence(F.lit(1), F.lit(n_quantiles - 1)), F.col("rows")
    if flavour == "sql":
        last = lambda i: i * F.floor(rows / n_quantiles) + F.least(i, rows % n_quantiles)
    else:
        last = lambda i: F.floor((rows - 1) * i / n_quantiles) + 1
    cuts = rows_at(metrics, [f"_{n}" for n in names], "CustomerID", F.transform(k, last))
    scored = scored.crossJoin(F.broadcast(cuts))

    def tile(name: str) -> Column:
        value, who = (F.col(name) * signs[name]).cast(_METRIC), F.col("CustomerID")
        behind = lambda cut: (value > cut["v"]) | ((value == cut["v"]) & (who > cut["key"]))
        return F.size(F.filter(f"_{name}", behind)) + 1

    for name, score in zip(names, ("R_Score", "F_Score", "M_Score")):
        number = F.lit(n_quantiles + 1) - tile(name) if name == "Recency" and flavour != "sql" else tile(name)
        scored = scored.withColumn(score, number.cast("bigint"))
    digits = [F.col(c).cast("string") for c in ("R_Score", "F_Score", "M_Score")]
    return scored.drop(*[f"_{n}" for n in names]).withColumn("RFM_Score", F.concat(*digits))


def segment_of(r: Column, f: Column, flavour: str = "python") -> Column:
    """First rule that fits. Spend plays no part; R=2 with F=1 fits none and gets the fallback."""
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 3) & (f == 2), "Potential Loyalists")
        .when((r >= 4) & (f == 1), "New Customers")
        .when((r == 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f >= 4), LOST_BIG[flavour])
        .when((r == 2) & (f == 2), "Need Attention")
        .when((r == 3) & (f == 1), "About to Sleep")
        .when((r == 1) & f.between(2, 3), "Hibernating")
        .when((r == 1) & (f == 1), "Lost")
        .otherwise(FALLBACK[flavour])
    )


def rfm_segments(scored: DataFrame, flavour: str = "python") -> DataFrame:
    return scored.withColumn("Segment", segment_of(F.col("R_Score"), F.col("F_Score"), flavour))


def rfm_summary(segments: DataFrame, flavour: str = "python") -> DataFrame:
    """Size, averages and shares per segment, strongest first."""
    stats = segments.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("Recency").alias("days"),
        F.sum("Frequency").alias("orders"),
        F.sum("Monetary").alias("spend"),
    )
    # ten rows
    everything = Window.partitionBy()
    count, spend = F.col("customers"), F.col("spend")
    share = percent(count, F.sum(count).over(everything))
    worth = percent(spend, F.sum(spend).over(everything))
    averages = [ratio(F.col(c), count) for c in ("days", "orders", "spend")]
    if flavour == "sql":
        days, orders, money = (rounded(a, d) for a, d in zip(averages, (1, 1, 2)))
        out = stats.select(
            F.col("Segment").alias("segment"),
            count.alias("customer_count"),
            days.alias("avg_recency_days"),
            orders.alias("avg_frequency_orders"),
            money.alias("avg_monetary_spend"),
            rounded(spend, 2).alias("total_segment_revenue"),
            share.alias("customer_percentage"),
            worth.alias("revenue_percentage"),
        )
        return out.orderBy(F.desc("total_segment_revenue"), "segment")
    out = stats.select(
        "Segment",
        count.alias("Customer_Count"),
        averages[0].alias("Avg_Recency"),
        averages[1].alias("Avg_Frequency"),
        averages[2].alias("Avg_Monetary"),
        spend.cast("double").alias("Total_Monetary"),
        share.alias("Customer_Percentage"),
        worth.alias("Revenue_Percentage"),
    )
    return out.orderBy(F.desc("Total_Monetary"), "Segment")


def segment_strategy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PLAYBOOK,
        "Segment string, Description string, Marketing_Goal string, Tactical_Action string, Primary_Channel string",
    )


def join_strategy(segments: DataFrame) -> DataFrame:
    """Every customer with the playbook of their segment (ten rows, so broadcast)."""
    return segments.join(F.broadcast(segment_strategy(segments.sparkSession)), "Segment", "left")


def rfm_full(cleaned: DataFrame, n_quantiles: int = 5) -> tuple[DataFrame, DataFrame]:
    """Segments per customer and their summary."""
    segments = rfm_segments(rfm_scores(rfm_base_full(cleaned), "python", n_quantiles))
    return segments, rfm_summary(segments)


def segments_sql(tx: DataFrame) -> DataFrame:
    return rfm_segments(rfm_scores(rfm_raw_sql(tx), "sql"), "sql")


def shown(segments: DataFrame) -> DataFrame:
    """With the exact spend as DOUBLE."""
    return segments.withColumn("Monetary", F.col("Monetary").cast("double"))


def segment_counts(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("Segment")
        .agg(F.count(F.lit(1)).alias("Customer_Count"))
        .orderBy(F.desc("Customer_Count"), "Segment")
    )


def segment_spend(segments: DataFrame) -> DataFrame:
    return segments.groupBy("Segment").agg(F.sum("Monetary").cast("double").alias("Monetary"))


def segment_filter(segments: DataFrame, segment: str, k: int = 100) -> DataFrame:
    """First customers of one segment."""
    rows = segments.where(F.col("Segment") == segment)
    listed = rows.select("CustomerID", big(F.col("Recency")).alias("Recency"), "Frequency", F.col("Monetary").cast("double").alias("Monetary"))
    return listed.orderBy("CustomerID").limit(k)
