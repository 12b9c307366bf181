"""Dates, rounding, segments and other rules on hand-made values."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.functions.dates import micros, quarter_label, week_label, week_number, whole_days, year_start
from tillroll.functions.money import rounded
from tillroll.plans import advanced, customers, products, revenue, rfm, views


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rounding_is_on_decimal_digits(spark):
    assert one(spark, rounded(F.lit(1.005), 2)) == 1.01
    assert one(spark, rounded(F.lit(0.285), 2)) == 0.29
    assert one(spark, rounded(F.lit(-2.5), 0)) == -3.0


def test_weeks_equal_strftime_on_every_day(spark):
    days = [datetime(2005, 1, 1) + timedelta(days=i) for i in range(0, 365 * 21)]
    frame = spark.createDataFrame([(d, d.strftime("%Y-%W")) for d in days], "d timestamp_ntz, expected string")
    d = F.col("d")
    assert frame.where(week_label(year_start(d), week_number(d)) != F.col("expected")).count() == 0


def test_whole_days_are_24_hours(spark):
    a, b = F.expr("timestamp_ntz'2011-03-26 12:00:00'"), F.expr("timestamp_ntz'2011-03-28 11:59:59'")
    assert one(spark, whole_days(a, b)) == 1
    assert one(spark, whole_days(a, b + F.expr("interval 1 second"))) == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_arithmetic_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a, b = F.expr("timestamp_ntz'2011-03-12 12:00:00'"), F.expr("timestamp_ntz'2011-03-13 12:00:00.25'")
        assert one(spark, whole_days(a, b)) == 1
        assert one(spark, micros(b) - micros(a)) == 86_400_250_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_quarters(spark):
    assert [one(spark, quarter_label(F.to_date(F.lit(f"2010-{m:02d}-15")))) for m in (1, 3, 4, 9, 12)] == [
        "Q1", "Q1", "Q2", "Q3", "Q4",
    ]


@pytest.mark.parametrize("flavour, lost, fallback", [("sql", "Cant Lose Them", "Lost"), ("python", "Can't Lose Them", "Need Attention")])
def test_segment_of_every_score_pair(spark, flavour, lost, fallback):
    pairs = [(r, f) for r in range(1, 6) for f in range(1, 6)]
    frame = spark.createDataFrame(pairs, "r int, f int")
    got = {(x["r"], x["f"]): x["s"] for x in frame.select("r", "f", rfm.segment_of(F.col("r"), F.col("f"), flavour).alias("s")).collect()}
    assert got[(2, 1)] == fallback
    assert got[(1, 4)] == got[(1, 5)] == lost
    assert got[(1, 1)] == "Lost"
    assert got[(1, 2)] == got[(1, 3)] == "Hibernating"
    assert got[(2, 2)] == "Need Attention"
    assert got[(3, 1)] == "About to Sleep"
    assert got[(4, 1)] == got[(5, 1)] == "New Customers"
    assert got[(3, 2)] == got[(5, 2)] == "Potential Loyalists"
    assert got[(2, 3)] == got[(2, 5)] == "At Risk"
    assert got[(3, 3)] == got[(5, 3)] == got[(3, 5)] == "Loyal Customers"
    assert got[(4, 4)] == got[(5, 5)] == "Champions"


def test_guests_and_cancellations_are_no_sales_but_lower_case_c_is(spark, lines):
    tx = lines(
        ("1", "A", 2, "2011-01-03", 5, "7"),
        ("C2", "A", -1, "2011-01-04", 5, "7"),
        ("c3", "A", 1, "2011-01-05", 5, "7"),
        ("4", "A", 9, "2011-01-06", 5, None),
    )
    row = revenue.revenue_monthly(tx).first()
    assert (row["monthly_revenue"], row["total_orders"], row["unique_active_customers"]) == (15.0, 2, 1)


def test_frequency_shares_count_cancel_only_customers(lines):
    tx = lines(("1", "A", 1, "2011-01-03", 5, "1"), ("C2", "A", -1, "2011-01-03", 5, "2"))
    row = customers.customers_frequency_dist(tx).first()
    assert (row["order_count"], row["customer_count"], row["customer_percentage"]) == (1, 1, 50.0)
    assert customers.customers_total(tx).first()[0] == 2


def test_recency_is_against_the_newest_line_of_all(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01", 5, "1"),
        ("2", "A", 1, "2011-03-01", 5, "2"),
        ("3", "A", 1, "2011-05-01", 5, None),
    )
    got = {r["customer_status"]: r["customer_count"] for r in customers.customers_active(tx).collect()}
    assert got == {"Active (<= 90 days)": 1, "Inactive (> 90 days)": 1}


def test_top_ranks_share_ties(lines):
    tx = lines(*[(str(i), "A", q, "2011-01-01", 5, str(i)) for i, q in enumerate([3, 3, 2, 1])])
    rows = {r["CustomerID"]: r["customer_spend_rank"] for r in customers.customers_top_spend(tx).collect()}
    assert rows == {"0": 1, "1": 1, "2": 3, "3": 4}


def test_customer_of_two_countries(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01", 5, "1", "France"),
        ("1", "B", 1, "2011-01-01", 5, "1", "Belgium"),
    )
    row = customers.customers_top_spend(tx).first()
    assert (row["Country"], row["total_orders"], row["total_spend"]) == ("Belgium", 1, 10.0)
    assert views.v_customer_summary(tx).count() == 2


def test_product_names_and_single_buyers(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01", 5, "1", "France", "ZEBRA"),
        ("2", "A", 4, "2011-01-01", 5, "1", "France", "APPLE"),
        ("2", "B", 1, "2011-01-01", 5, "1", "France", "B"),
        ("3", "B", 1, "2011-01-01", 5, "2", "France", "B"),
    )
    assert [tuple(r) for r in products.products_single_buyer(tx).collect()] == [("A", "APPLE", 1)]
    top = products.products_top_revenue(tx).first()
    assert (top["StockCode"], top["Description"], top["total_revenue"], top["order_count"]) == ("A", "APPLE", 25.0, 2)


def test_return_rate_of_popular_products_only(lines):
    tx = lines(
        ("1", "A", 200, "2011-01-01", 1, "1"),
        ("C2", "A", -50, "2011-01-02", 1, "1"),
        ("3", "B", 100, "2011-01-01", 1, "1"),
    )
    rows = products.products_return_rate(tx).collect()
    assert [(r["StockCode"], r["return_rate_pct"]) for r in rows] == [("A", 25.0)]


def test_growth_over_a_month_without_revenue_is_null(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01", 0, "1"),
        ("2", "A", 1, "2011-02-01", 5, "1"),
        ("3", "A", 2, "2011-03-01", 5, "1"),
    )
    assert [r["mom_growth_percentage"] for r in advanced.adv_mom_growth(tx).orderBy("year_month").collect()] == [
        None, None, 100.0,
    ]


def test_an_invoice_with_two_times_counts_twice_between_purchases(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01 00:00:00", 5, "1"),
        ("1", "B", 1, "2011-01-02 00:00:00", 5, "1"),
        ("2", "B", 1, "2011-01-04 00:00:00", 5, "1"),
    )
    row = advanced.adv_purchase_gaps(tx).first()
    assert (row["repeat_purchase_count"], row["avg_days_between_purchases"]) == (2, 1.5)


def test_cross_sell_and_its_strict_form(lines):
    sold = [("1", "X", 1, "2011-01-01", 5, "1"), ("2", "X", 1, "2011-01-01", 5, "2"), ("3", "Y", 1, "2011-01-01", 5, "2")]
    guest = ("4", "Y", 1, "2011-01-01", 5, None)
    options = {"bought": "X", "missing": "Y"}
    without, with_guest = lines(*sold), lines(*sold, guest)
    assert [r[0] for r in advanced.cross_sell(without, **options).collect()] == ["1"]
    assert [r[0] for r in advanced.cross_sell(with_guest, **options).collect()] == ["1"]
    assert [r[0] for r in advanced.cross_sell_strict(without, **options).collect()] == ["1"]
    assert advanced.cross_sell_strict(with_guest, **options).count() == 0


def test_cumulative_revenue_shares_ties(lines):
    tx = lines(
        ("1", "A", 1, "2011-01-01", 5, "1", "France"),
        ("2", "A", 1, "2011-01-01", 5, "1", "Spain"),
        ("3", "A", 1, "2011-01-01", 2, "1", "EIRE"),
    )
    got = {r["Country"]: r["cumulative_running_revenue"] for r in advanced.adv_country_cumulative(tx).collect()}
    assert got == {"France": 10.0, "Spain": 10.0, "EIRE": 12.0}


def test_rfm_needs_its_columns(spark):
    with pytest.raises(ValueError, match="Monetary"):
        rfm.validate_rfm_input(spark.createDataFrame([("1", 1, 1)], "`Customer ID` string, Recency int, Frequency int"))


def test_scores_cover_all_quantiles(spark):
    base = spark.range(23).select(
        F.col("id").cast("string").alias("CustomerID"),
        F.lit(5).alias("Recency"),
        F.col("id").alias("Frequency"),
        (F.col("id") * 2).alias("Monetary"),
    )
    scored = rfm.rfm_scores(base).toPandas()
    for column in ("R_Score", "F_Score", "M_Score"):
        assert set(scored[column]) == {1, 2, 3, 4, 5}
    summary = rfm.rfm_summary(rfm.rfm_segments(rfm.rfm_scores(base))).toPandas()
    assert summary["Customer_Count"].sum() == 23
    assert summary["Customer_Percentage"].sum() == pytest.approx(100, abs=0.05)


def test_playbook_has_every_segment(spark):
    names = {r["Segment"] for r in rfm.segment_strategy(spark).collect()}
    assert len(names) == 10
    assert {"Champions", "Can't Lose Them", "Lost"} <= names
