"""Customer features over an observation window and spend in the window after it.

Input are cleaned lines (with ``Revenue``). No step gathers a customer's lines
in one task: lines are first summed per invoice time, then per customer and day,
and only day rows, bounded by the calendar, meet in a window per customer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tillroll.functions.dates import micros, month_start, whole_days
from tillroll.functions.money import percent, ratio
from tillroll.schema import HOME_MARKET
from tillroll.staging import written

FEATURES = [
    "Frequency",
    "Monetary",
    "Recency",
    "Tenure",
    "Product_Diversity",
    "Avg_Basket_Size",
    "Avg_Order_Value",
    "Avg_Monthly_Spend",
    "Seasonal_Score_Q4",
    "Avg_Purchase_Interval",
    "Revenue_Growth",
    "Is_UK",
]
TARGET = "target_revenue"
SINGLE_ORDER_INTERVAL = 999.0
TINY = 1e-5

def _per_customer() -> WindowSpec:
    return Window.partitionBy("CustomerID")


def _moment(day: str) -> Column:
    return F.to_timestamp_ntz(F.lit(day))


def date_window(lines: DataFrame, start: str, days: int) -> DataFrame:
    """Lines in ``[start, start + days)``."""
    begin = _moment(start)
    end = begin + F.make_dt_interval(F.lit(days))
    return lines.where((F.col("InvoiceDate") >= begin) & (F.col("InvoiceDate") < end))


def split_windows(lines: DataFrame, split: str, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """Lines before the split, and those of the ``days`` from it on."""
    return lines.where(F.col("InvoiceDate") < _moment(split)), date_window(lines, split, days)


def invoice_times(lines: DataFrame) -> DataFrame:
    """Units and revenue per customer, country, invoice and time."""
    day = F.col("InvoiceDate").cast("date")
    return (
        lines.groupBy("CustomerID", "Country", "Invoice", "InvoiceDate")
        .agg(F.sum("Quantity").alias("units"), F.sum("Revenue").alias("revenue"))
        .withColumn("day", day)
    )


def invoice_days(times: DataFrame) -> DataFrame:
    """One row per customer and day on which invoices began, with the whole days since the one before.

    An invoice is dated by its first line. Two invoices of one day are less than
    a whole day apart, so the gaps within a day are all zero and only the gap
    between day rows counts.
    """
    invoices = times.groupBy("CustomerID", "Invoice").agg(
        F.min("InvoiceDate").alias("began"),
        F.max("InvoiceDate").alias("ended"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
    )
    days = invoices.groupBy("CustomerID", F.col("began").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("began").alias("first"),
        F.max("began").alias("last"),
        F.max("ended").alias("ended"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
    )
    before = F.lag("last").over(_per_customer().orderBy("day"))
    return days.withColumn("gap", whole_days(before, F.col("first")))


def _rfm_measures(reference: str, first: str = "first") -> list[Column]:
    at = _moment(reference)
    return [
        F.sum("orders").alias("Frequency"),
        F.sum("revenue").alias("Monetary"),
        whole_days(F.max("ended"), at).alias("Recency"),
        whole_days(F.min(first), at).alias("Tenure"),
    ]


def _basket_measures() -> list[Column]:
    """Means per invoice, which are totals over the number of invoices."""
    return [
        ratio(F.sum("units"), F.sum("orders")).alias("Avg_Basket_Size"),
        ratio(F.sum("revenue"), F.sum("orders")).alias("Avg_Order_Value"),
    ]


def _interval_measure() -> Column:
    """Mean whole days between a customer's invoices; without a gap between days, those of one day are 0 days apart."""
    average = ratio(F.coalesce(F.sum("gap"), F.lit(0)), F.sum("orders") - 1)
    return F.coalesce(average, F.lit(SINGLE_ORDER_INTERVAL)).alias("Avg_Purchase_Interval")


def rfm_base(invoices: DataFrame, reference: str) -> DataFrame:
    return invoices.groupBy("CustomerID").agg(*_rfm_measures(reference))


def basket_means(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("CustomerID").agg(*_basket_measures())


def purchase_interval(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("CustomerID").agg(_interval_measure())


def product_diversity(lines: DataFrame) -> DataFrame:
    return lines.groupBy("CustomerID").agg(F.countDistinct("StockCode").alias("Product_Diversity"))


def customer_days(times: DataFrame) -> DataFrame:
    """One row per customer and day with lines.

    ``middle`` is the customer's midpoint in time, doubled to stay an integer;
    ``opens_month`` is 1 on the first day row of a month.
    """
    per_day = times.groupBy("CustomerID", "day").agg(
        F.sum("revenue").alias("revenue"),
        micros(F.min("InvoiceDate")).alias("first"),
        micros(F.max("InvoiceDate")).alias("last"),
    )
    month = month_start(F.col("day"))
    seen = month.eqNullSafe(F.lag(month).over(_per_customer().orderBy("day")))
    return per_day.withColumns({
        "middle": F.min("first").over(_per_customer()) + F.max("last").over(_per_customer()),
        "opens_month": F.when(seen, 0).otherwise(1),
    })


def _spend_measure() -> Column:
    """Mean over the months with a purchase; a month counts on its first day row."""
    return ratio(F.sum("revenue"), F.sum("opens_month")).alias("Avg_Monthly_Spend")


def _season_measure() -> Column:
    last_quarter = F.when(F.quarter("day") == 4, F.col("revenue")).otherwise(0)
    return F.coalesce(ratio(F.sum(last_quarter), F.sum("revenue")), F.lit(0.0)).alias("Seasonal_Score_Q4")


def _half_measures() -> list[Column]:
    """Spend on the days that lie wholly before or after a customer's midpoint."""
    early, late = F.col("last") * 2 <= F.col("middle"), F.col("first") * 2 > F.col("middle")
    return [
        F.sum(F.when(early, F.col("revenue")).otherwise(0)).alias("first_half"),
        F.sum(F.when(late, F.col("revenue")).otherwise(0)).alias("second_half"),
    ]


def monthly_spend(days: DataFrame) -> DataFrame:
    return days.groupBy("CustomerID").agg(_spend_measure())


def seasonal_score(days: DataFrame) -> DataFrame:
    return days.groupBy("CustomerID").agg(_season_measure())


def _is_cut() -> Column:
    """Is it the day, one at most, that a customer's midpoint cuts?"""
    return (F.col("first") * 2 <= F.col("middle")) & (F.col("last") * 2 > F.col("middle"))


def _with_cut_day(halves: DataFrame, times: DataFrame, cut: DataFrame) -> DataFrame:
    """Add the two parts of the days that are cut; the midpoint itself is in the first.

    Those lines join on customer and day, so that a customer with very many
    lines is spread over their days.
    """
    on_time = F.when(micros(F.col("InvoiceDate")) * 2 <= F.col("middle"), F.col("revenue")).otherwise(0)
    parts = (
        times.join(cut.select("CustomerID", "day", "middle", F.col("revenue").alias("cut_day")), ["CustomerID", "day"])
        .groupBy("CustomerID")
        .agg(F.sum(on_time).alias("early"), F.max("cut_day").alias("cut_day"))
    )
    early, late = F.col("early"), F.col("cut_day") - F.col("early")
    return halves.join(parts, "CustomerID", "left").withColumns({
        "first_half": F.col("first_half") + F.coalesce(early, F.lit(0)),
        "second_half": F.col("second_half") + F.coalesce(late, F.lit(0)),
    }).drop("early", "cut_day")


def spend_halves(times: DataFrame, days: DataFrame) -> DataFrame:
    """Spend in the first and second half of each customer's time."""
    return _with_cut_day(days.groupBy("CustomerID").agg(*_half_measures()), times, days.where(_is_cut()))


def _growth() -> Column:
    """Relative change of spend between the halves; a customer with one date gets nearly -1."""
    first, second = F.col("first_half"), F.col("second_half")
    change = (second - first).cast("double") / (first.cast("double") + F.lit(TINY))
    return change.alias("Revenue_Growth")


def revenue_growth(times: DataFrame, days: DataFrame) -> DataFrame:
    return spend_halves(times, days).select("CustomerID", _growth())


def first_country(times: DataFrame) -> DataFrame:
    """Country of a customer's earliest line that has one; of several at that time the first by name."""
    earliest = F.min_by("Country", F.struct("InvoiceDate", "Country"))
    return times.where(F.col("Country").isNotNull()).groupBy("CustomerID").agg(earliest.alias("Country"))


def is_uk(times: DataFrame) -> DataFrame:
    home = (F.col("Country") == HOME_MARKET).cast("bigint")
    return first_country(times).select("CustomerID", home.alias("Is_UK"))


def target_revenue(prediction: DataFrame) -> DataFrame:
    return prediction.groupBy("CustomerID").agg(F.sum("Revenue").cast("double").alias(TARGET))


def _joined(tables: list[DataFrame]) -> DataFrame:
    """All are at customer grain and partitioned by the customer already."""
    return reduce(lambda left, right: left.join(right, "CustomerID", "left"), tables)


def behavioural_features(observed: DataFrame) -> DataFrame:
    times = written(invoice_times(observed), "times", "zstd")
    return _behaviour(observed, times)


def _all_days(times: DataFrame) -> DataFrame:
    """What ``customer_days`` and ``invoice_days`` tell, in one row per customer and day with lines.

    The invoices only add when they began, so that the days of both meet in one grouping and one window. ``home`` is
    four times the earliest microsecond with a country, plus 1 if that country (of several the first by name) is the
    home market, 0 if it comes before that by name, and 2 if after.
    """
    begun = times.groupBy("CustomerID", "Invoice").agg(F.min("InvoiceDate").alias("began"))
    begun = begun.select("CustomerID", F.col("began").cast("date").alias("day"), "began")
    place = F.when(F.col("Country") < HOME_MARKET, 0).when(F.col("Country") == HOME_MARKET, 1).when(F.col("Country") > HOME_MARKET, 2)
    home = (micros(F.col("InvoiceDate")) * 4 + place).alias("home")
    rows = times.select("CustomerID", "day", "InvoiceDate", "units", "revenue", home)
    per_day = rows.unionByName(begun, allowMissingColumns=True).groupBy("CustomerID", "day").agg(
        F.count("began").alias("orders"),
        F.min("began").alias("first_began"),
        F.max("began").alias("last_began"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.min("InvoiceDate").alias("opened"),
        F.max("InvoiceDate").alias("ended"),
        F.min("home").alias("home"),
    )
    along = _per_customer().orderBy("day")
    # a day on which no invoice began is no end of a gap
    before = F.last("last_began", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    month = month_start(F.col("day"))
    seen = month.eqNullSafe(F.lag(month).over(along))
    middle = micros(F.min("opened").over(_per_customer())) + micros(F.max("ended").over(_per_customer()))
    return per_day.withColumns({
        "gap": whole_days(before, F.col("first_began")),
        "middle": middle,
        "opens_month": F.when(seen, 0).otherwise(1),
        "first": micros(F.col("opened")),
        "last": micros(F.col("ended")),
    })


def _behaviour(observed: DataFrame, times: DataFrame, *more: Column) -> DataFrame:
    cut = F.max(F.when(_is_cut(), F.struct("day", "middle", "revenue"))).alias("cut")
    home = (F.pmod(F.min("home"), F.lit(4)) == 1).cast("bigint").alias("Is_UK")
    measures = [*more, *_basket_measures(), _interval_measure(), _spend_measure(), _season_measure(), *_half_measures()]
    customers = written(_all_days(times).groupBy("CustomerID").agg(*measures, cut, home), "customers", "zstd")
    # few days are cut, and as a table of their own they show it: no other lines need to be shuffled to find theirs
    cuts = written(customers.where(F.col("cut").isNotNull()).select("CustomerID", "cut.*"), "cuts", "zstd")
    spend = _with_cut_day(customers.drop("cut"), times, cuts).withColumn("Revenue_Growth", _growth())
    table = _joined([spend.drop("first_half", "second_half"), product_diversity(observed)])
    return table.select("CustomerID", *[c for c in FEATURES if c in table.columns])


def feature_table(cleaned: DataFrame, split: str, days: int = 90) -> DataFrame:
    """Features of everyone who bought before ``split``, with their spend in the ``days`` after it."""
    observed, _ = split_windows(cleaned, split, days)
    until = _moment(split) + F.make_dt_interval(F.lit(days))
    # both windows are summed to invoices in one pass; the target needs no more than those of the second
    both = written(invoice_times(cleaned.where(F.col("InvoiceDate") < until)), "times", "zstd")
    times, later = both.where(F.col("InvoiceDate") < _moment(split)), both.where(F.col("InvoiceDate") >= _moment(split))
    target = later.groupBy("CustomerID").agg(F.sum("revenue").cast("double").alias(TARGET))
    table = _joined([_behaviour(observed, times, *_rfm_measures(split, "opened")), target])
    whole = ("Frequency", "Recency", "Tenure", "Product_Diversity", "Is_UK")
    filled = [
        F.coalesce(F.col(c).cast("bigint" if c in whole else "double"), F.lit(0)).alias(c)
        for c in [*FEATURES, TARGET]
    ]
    return table.select("CustomerID", *filled)


def returning_rate(features: DataFrame) -> DataFrame:
    back = F.count(F.when(F.col(TARGET) > 0, 1))
    return features.agg(
        F.count(F.lit(1)).alias("customers"),
        back.alias("returning_customers"),
        percent(back, F.count(F.lit(1))).alias("returning_pct"),
    )


def fit_scaler(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """One row: centre and spread of every column, by population deviation or by range. A constant column's spread is 1."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method: {method}")
    centre, spread = {
        "standard": (F.avg, F.stddev_pop),
        "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
    }[method]
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        width = spread(value)
        stats.append(F.struct(centre(value).alias("centre"), F.when(width == 0, 1.0).otherwise(width).alias("spread")).alias(c))
    return df.agg(*stats)


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """``df`` with the columns of a fitted scaler in its units; the scaler may come from other rows."""
    fitted = F.broadcast(scaler.select(F.struct("*").alias("_fit")))
    part = lambda c: F.col("_fit")[c]
    scaled = {c: (F.col(c).cast("double") - part(c)["centre"]) / part(c)["spread"] for c in scaler.columns}
    return df.crossJoin(fitted).withColumns(scaled).select(*df.columns)


def scale(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    return apply_scaler(df, fit_scaler(df, columns, method))
