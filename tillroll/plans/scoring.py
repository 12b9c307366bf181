"""Predicted values per customer and what follows from them: tiers, attribution, formulas."""

from __future__ import annotations

from typing import Any

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.functions.money import ratio
from tillroll.operators.ordering import global_row_number
from tillroll.plans.features import TINY

PREDICTED = "predicted_cltv"


def score_batch(model: Transformer, customers: DataFrame) -> DataFrame:
    """Predictions for all customers, never below zero."""
    scored = model.transform(customers)
    return scored.withColumn(PREDICTED, F.greatest(F.lit(0.0), F.col("prediction"))).select(
        *customers.columns, PREDICTED
    )


def score_whatif(model: Transformer, customers: DataFrame, **overrides: Any) -> DataFrame:
    """Predictions with some features replaced by values or expressions, for any set of customers."""
    unknown = set(overrides) - set(customers.columns)
    if unknown:
        raise ValueError(f"no such features: {sorted(unknown)}")
    changed = {k: v if isinstance(v, Column) else F.lit(v) for k, v in overrides.items()}
    return score_batch(model, customers.withColumns(changed) if changed else customers)


# Tiers with their floor, acquisition cost cap and texts.
TIERS = [
    (
        "VIP",
        150.0,
        "VIP Tier: Exclusive Loyalty Program Entry & Dedicated Account Outreach",
        "Offer invitation to key collections previews and reward bonus acceleration.",
        "350%",
        "High (92%)",
    ),
    (
        "Core",
        40.0,
        "Core Tier: Targeted Cross-Category Product Bundles Campaign",
        "Push recommendation emails containing matched item pairs.",
        "220%",
        "Medium-High (85%)",
    ),
    (
        "Volume",
        10.0,
        "Volume Tier: Low-cost automated reactivation sequences",
        "Send email sequence highlighting popular discount items.",
        "140%",
        "Medium (78%)",
    ),
]
TIER_COLUMNS = "Tier string, CAC_Cap double, Strategy string, Next_Action string, Expected_ROI string, Confidence string"
VIP_ABOVE, CORE_FROM = 1200, 200


def tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TIERS, TIER_COLUMNS)


def cac_tier_threshold(scored: DataFrame) -> DataFrame:
    """Tier by predicted value, with its three-row table of actions."""
    value = F.col(PREDICTED)
    tier = F.when(value > VIP_ABOVE, "VIP").when(value >= CORE_FROM, "Core").otherwise("Volume")
    marked = scored.select("CustomerID", PREDICTED, tier.alias("Tier"))
    return marked.join(F.broadcast(tiers(scored.sparkSession)), "Tier", "left")


def cac_tier_percentile(scored: DataFrame) -> DataFrame:
    """Tier by rank: the best tenth, the next four tenths, the rest. Need not agree with the thresholds."""
    placed = global_row_number(
        scored.select("CustomerID", PREDICTED), [F.desc(PREDICTED), F.asc("CustomerID")], "place", "customers"
    )
    place, everyone = F.col("place") * 10, F.col("customers")
    tier = F.when(place <= everyone, "VIP").when(place <= everyone * 5, "Core").otherwise("Volume")
    caps = F.broadcast(tiers(scored.sparkSession).select("Tier", "CAC_Cap"))
    return placed.select("CustomerID", PREDICTED, "place", tier.alias("Tier")).join(caps, "Tier", "left")


# Weight of one standard deviation of each feature; recency counts against the customer.
WEIGHTS = {"Monetary": 180.0, "Frequency": 70.0, "Recency": -110.0, "Tenure": 45.0, "Avg_Monthly_Spend": 55.0}
DEFAULT_BASELINE = 120.0
SCALE_LIMITS = (0.1, 5.0)


def attribution_local(scored: DataFrame) -> DataFrame:
    """What lifts each customer's prediction above or below the average, for all customers.

    Weighted z-scores, scaled towards the distance from the average prediction.
    The scale is limited, so the parts need not add up to it.
    """
    stats = [F.avg(PREDICTED).alias("_average")]
    for c in WEIGHTS:
        stats += [F.avg(c).alias(f"_{c}_mean"), F.stddev_samp(c).alias(f"_{c}_std")]
    base = scored.crossJoin(F.broadcast(scored.agg(*stats)))

    def part(c: str, weight: float) -> Column:
        return (F.col(c) - F.col(f"_{c}_mean")) / (F.col(f"_{c}_std") + F.lit(TINY)) * F.lit(weight)

    raw = base.withColumns({f"_{c}": part(c, w) for c, w in WEIGHTS.items()}).withColumn(
        "baseline", F.when(F.col("_average") > 0, F.col("_average")).otherwise(DEFAULT_BASELINE)
    )
    together = sum((F.col(f"_{c}") for c in WEIGHTS), F.lit(0.0)) + F.lit(TINY)
    wanted = (F.col(PREDICTED) - F.col("baseline")) / together
    low, high = (F.lit(v) for v in SCALE_LIMITS)
    return raw.withColumn("scale", F.least(F.greatest(wanted, low), high)).select(
        "CustomerID",
        PREDICTED,
        "baseline",
        *[(F.col(f"_{c}") * F.col("scale")).alias(f"{c}_impact") for c in WEIGHTS],
    )


def customer_profile(scored: DataFrame, segments: DataFrame) -> DataFrame:
    """The facts shown for a customer, for all customers."""
    home = F.when(F.col("Is_UK") == 1, "United Kingdom (Domestic)").otherwise("International")
    return scored.join(segments.select("CustomerID", "Segment"), "CustomerID", "left").select(
        "CustomerID",
        home.alias("Home_Market"),
        F.col("Tenure").alias("Tenure_Days"),
        F.col("Frequency").alias("Orders"),
        F.col("Monetary").alias("Total_Revenue"),
        "Avg_Basket_Size",
        F.coalesce("Segment", F.lit("N/A")).alias("Segment"),
        PREDICTED,
    )


def profile_join(features: DataFrame, segments: DataFrame) -> DataFrame:
    scores = segments.select("CustomerID", "R_Score", "F_Score", "M_Score", "RFM_Score", "Segment")
    return features.join(scores, "CustomerID", "left")


def customer_lines(cleaned: DataFrame, customer: str) -> DataFrame:
    """One customer's lines over time."""
    return cleaned.where(F.col("CustomerID") == customer).orderBy("InvoiceDate", "Invoice", "StockCode")


def customer_timeline(cleaned: DataFrame, customer: str) -> DataFrame:
    """Value, size and price of a customer's lines over time."""
    return customer_lines(cleaned, customer).select(
        "InvoiceDate",
        *[F.col(c).cast("double").alias(c) for c in ("Revenue", "Quantity", "Price")],
    )


def cltv_traditional(features: DataFrame, churn_rate: float | Column, margin: float = 0.3) -> DataFrame:
    """Order value x orders / churn x margin per customer; NULL without churn."""
    churn = churn_rate if isinstance(churn_rate, Column) else F.lit(churn_rate)
    value = ratio(F.col("Avg_Order_Value") * F.col("Frequency"), churn) * margin
    return features.select("CustomerID", "Avg_Order_Value", "Frequency", value.alias("cltv"))


def cltv_discounted(
    features: DataFrame, horizon: int = 12, discount: float = 0.1, cost_share: float = 0.7, survival: float = 0.9
) -> DataFrame:
    """Monthly profit over ``horizon`` periods, discounted and weighted by the chance of still being active."""
    profit = F.col("Avg_Monthly_Spend") * F.lit(1.0 - cost_share)

    def add(total: Column, t: Column) -> Column:
        return total + profit * F.pow(F.lit(survival), t) / F.pow(F.lit(1.0 + discount), t)

    value = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.lit(0.0), add)
    return features.select("CustomerID", "Avg_Monthly_Spend", value.alias("cltv"))
