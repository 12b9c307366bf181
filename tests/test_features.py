"""The feature table against a row-by-row computation in pandas."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.plans import features

SPLIT = "2011-06-01"


@pytest.fixture(scope="module")
def cleaned_frame():
    """Random lines: invoices over two times and days, customers in two countries, one-date customers."""
    rng = np.random.default_rng(11)
    rows = []
    for invoice in range(260):
        customer = "1" if rng.random() < 0.33 else str(int(rng.integers(2, 25)))
        start = pd.Timestamp("2010-01-01") + pd.Timedelta(seconds=int(rng.integers(0, 600 * 86_400)))
        country = "United Kingdom" if rng.random() < 0.6 else "France"
        for line in range(int(rng.integers(1, 6))):
            late = pd.Timedelta(hours=int(rng.integers(1, 40))) if rng.random() < 0.1 else pd.Timedelta(0)
            quantity, price = int(rng.integers(1, 50)), int(rng.integers(1, 2000)) / 100
            rows.append((str(invoice), f"P{int(rng.integers(0, 30))}", quantity, start + late, customer, country, round(quantity * price, 2)))
    rows.append(("9001", "P1", 5, pd.Timestamp("2011-02-03 10:00:00"), "900", "France", 12.5))
    rows.append(("9002", "P1", 5, pd.Timestamp("2011-07-03 10:00:00"), "901", "France", 12.5))
    return pd.DataFrame(rows, columns=["Invoice", "StockCode", "Quantity", "InvoiceDate", "CustomerID", "Country", "Revenue"])


@pytest.fixture(scope="module")
def cleaned(spark, cleaned_frame):
    raw = spark.createDataFrame(cleaned_frame)
    return raw.select(
        "Invoice", "StockCode", F.col("Quantity").cast("decimal(16,4)").alias("Quantity"),
        F.col("InvoiceDate").cast("timestamp_ntz").alias("InvoiceDate"), "CustomerID", "Country",
        F.col("Revenue").cast("decimal(24,6)").alias("Revenue"),
    )


def expected(frame):
    split = pd.Timestamp(SPLIT)
    end = split + pd.Timedelta(days=90)
    out = []
    for customer, rows in frame[frame.InvoiceDate < split].groupby("CustomerID"):
        invoices = rows.groupby("Invoice").agg(at=("InvoiceDate", "min"), units=("Quantity", "sum"), money=("Revenue", "sum"))
        at = invoices["at"].sort_values()
        gaps = at.diff().dropna().dt.days
        middle = rows.InvoiceDate.min() + (rows.InvoiceDate.max() - rows.InvoiceDate.min()) / 2
        early = rows[rows.InvoiceDate <= middle].Revenue.sum()
        late = rows[rows.InvoiceDate > middle].Revenue.sum()
        first = rows.sort_values(["InvoiceDate", "Country"]).iloc[0]
        future = frame[(frame.CustomerID == customer) & (frame.InvoiceDate >= split) & (frame.InvoiceDate < end)]
        out.append({
            "CustomerID": customer,
            "Frequency": len(invoices),
            "Monetary": rows.Revenue.sum(),
            "Recency": (split - rows.InvoiceDate.max()).days,
            "Tenure": (split - rows.InvoiceDate.min()).days,
            "Product_Diversity": rows.StockCode.nunique(),
            "Avg_Basket_Size": invoices.units.mean(),
            "Avg_Order_Value": invoices.money.mean(),
            "Avg_Monthly_Spend": rows.groupby(rows.InvoiceDate.dt.to_period("M")).Revenue.sum().mean(),
            "Seasonal_Score_Q4": rows[rows.InvoiceDate.dt.quarter == 4].Revenue.sum() / rows.Revenue.sum(),
            "Avg_Purchase_Interval": gaps.mean() if len(gaps) else 999.0,
            "Revenue_Growth": (late - early) / (early + 1e-5),
            "Is_UK": int(first.Country == "United Kingdom"),
            "target_revenue": future.Revenue.sum(),
        })
    return pd.DataFrame(out).sort_values("CustomerID").reset_index(drop=True)


def test_feature_table_equals_pandas(cleaned, cleaned_frame):
    got = features.feature_table(cleaned, SPLIT).toPandas().sort_values("CustomerID").reset_index(drop=True)
    want = expected(cleaned_frame)
    assert list(got.columns) == list(want.columns)
    assert list(got.CustomerID) == list(want.CustomerID)
    for column in want.columns[1:]:
        assert got[column].to_numpy(float) == pytest.approx(want[column].to_numpy(float), rel=1e-9, abs=1e-9), column


def test_halves_sum_to_spend(cleaned):
    times = features.invoice_times(cleaned)
    halves = features.spend_halves(times, features.customer_days(times))
    total = cleaned.groupBy("CustomerID").agg(F.sum("Revenue").alias("total"))
    both = halves.join(total, "CustomerID")
    assert both.count() == total.count()
    assert both.where("first_half + second_half <> total").count() == 0


def test_one_date_customer(cleaned):
    row = features.feature_table(cleaned, SPLIT).where("CustomerID = '900'").first()
    assert row["Avg_Purchase_Interval"] == 999.0
    assert row["Revenue_Growth"] == pytest.approx(-1, abs=1e-5)


def test_windows_are_half_open(cleaned, lines):
    tx = lines(
        ("1", "A", 1, "2011-05-31 23:59:59", 1, "1"),
        ("2", "A", 1, "2011-06-01 00:00:00", 1, "1"),
        ("3", "A", 1, "2011-08-29 23:59:59", 1, "1"),
        ("4", "A", 1, "2011-08-30 00:00:00", 1, "1"),
    )
    before, after = features.split_windows(tx, SPLIT, 90)
    assert [r["Invoice"] for r in before.collect()] == ["1"]
    assert sorted(r["Invoice"] for r in after.collect()) == ["2", "3"]


def test_returning_rate(cleaned, cleaned_frame):
    row = features.returning_rate(features.feature_table(cleaned, SPLIT)).first()
    want = expected(cleaned_frame)
    assert row["customers"] == len(want)
    assert row["returning_customers"] == (want.target_revenue > 0).sum()


def test_scaling_uses_population_deviation_and_zeroes_constants(spark):
    frame = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 5), ("c", 6.0, 5)], "CustomerID string, x double, y int")
    got = features.scale(frame, ["x", "y"]).toPandas().sort_values("CustomerID")
    values = np.array([1.0, 2.0, 6.0])
    assert got.x.to_numpy() == pytest.approx((values - values.mean()) / values.std())
    assert (got.y == 0).all()
    got = features.scale(frame, ["x", "y"], "minmax").toPandas().sort_values("CustomerID")
    assert got.x.to_numpy() == pytest.approx([0, 0.2, 1])
    assert (got.y == 0).all()
    with pytest.raises(ValueError):
        features.scale(frame, ["x"], "robust")


def test_invoices_of_a_single_day_are_no_days_apart(spark):
    rows = [
        ("1", "A", 1, "2011-01-03 09:00:00", "1"), ("2", "A", 1, "2011-01-03 17:00:00", "1"), ("3", "B", 1, "2011-01-03 09:00:00", "2"),
    ]
    raw = spark.createDataFrame(rows, "Invoice string, StockCode string, Quantity int, at string, CustomerID string")
    lines = raw.select(
        "Invoice", "StockCode", F.col("Quantity").cast("decimal(16,4)").alias("Quantity"),
        F.col("at").cast("timestamp_ntz").alias("InvoiceDate"), "CustomerID", F.lit("France").alias("Country"),
        F.lit(2).cast("decimal(24,6)").alias("Revenue"),
    )
    wanted = {"1": 0.0, "2": features.SINGLE_ORDER_INTERVAL}
    for got in (features.feature_table(lines, SPLIT), features.behavioural_features(lines)):
        assert {r.CustomerID: r.Avg_Purchase_Interval for r in got.collect()} == wanted


def _made(spark, rows):
    """Cleaned lines of one unit and of revenue 2 from (invoice, time, customer, country)."""
    raw = spark.createDataFrame(rows, "Invoice string, at string, CustomerID string, Country string")
    return raw.select(
        "Invoice", F.lit("A").alias("StockCode"), F.lit(1).cast("decimal(16,4)").alias("Quantity"),
        F.col("at").cast("timestamp_ntz").alias("InvoiceDate"), "CustomerID", "Country",
        F.lit(2).cast("decimal(24,6)").alias("Revenue"),
    )


def test_invoices_over_midnight_and_countries_of_one_time(spark):
    """An invoice counts on the day it began, and a day on which none began ends no gap."""
    cleaned = _made(spark, [
        ("1", "2011-01-03 23:00:00", "1", "United Kingdom"), ("1", "2011-01-04 01:00:00", "1", None),
        ("2", "2011-01-06 23:00:00", "1", "France"),
        ("3", "1969-12-31 23:00:00", "2", "United Kingdom"), ("3", "1969-12-31 23:00:00", "2", "France"),
        ("4", "1969-12-31 23:00:00", "3", "United Kingdom"), ("4", "1969-12-31 23:00:00", "3", "Vietnam"),
        ("5", "2011-01-03 23:00:00", "4", None),
    ])
    for got in (features.feature_table(cleaned, SPLIT), features.behavioural_features(cleaned)):
        rows = {r.CustomerID: r for r in got.collect()}
        assert rows["1"].Avg_Purchase_Interval == 3.0
        assert rows["1"].Avg_Basket_Size == 1.5
        assert [rows[c].Is_UK or 0 for c in "1234"] == [1, 0, 1, 0]
    assert features.feature_table(cleaned, SPLIT).where("CustomerID = '1'").first().Frequency == 2


def test_each_time_is_shuffled_for_the_sums_alone(spark):
    """The days of lines and of invoices share a window, and the few days that are cut find their lines without a shuffle."""
    rows = [(str(i), f"2010-{i % 12 + 1:02d}-{i % 28 + 1:02d} 0{i % 10}:00:00", str(i % 499), "France") for i in range(20_000)]
    cleaned = _made(spark, [*rows, ("x", "2010-03-05 23:00:00", "one", "France"), ("y", "2010-03-05 01:00:00", "one", "France")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40k")
    try:
        for table in (features.feature_table(cleaned, SPLIT), features.behavioural_features(cleaned)):
            assert table.where("CustomerID = 'one'").first().Revenue_Growth == pytest.approx(0, abs=1e-5)
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "Window" not in plan and "hashpartitioning(CustomerID" in plan
            assert not re.search(r"hashpartitioning\(CustomerID#\d+, day#", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
