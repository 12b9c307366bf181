"""Every registered query by name: (session, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.catalog import tables as t
from tillroll.functions.dates import month_label, month_start, whole_days
from tillroll.functions.money import line_revenue, mean, percent, ratio, rounded, total
from tillroll.functions.rules import basket_size, is_abroad, is_cancelled, is_priced, is_valid_sale, qcut_of_rank
from tillroll.operators import joins, ordering, quantiles, sketches
from tillroll.plans import (
    advanced,
    cleaning,
    customers,
    daily,
    features,
    growing,
    kpis,
    modelling,
    products,
    profile,
    revenue,
    rfm,
    scoring,
    views,
)
from tillroll.plans.features import TARGET
from tillroll.schema import TRANSACTIONS, validate_schema
from tillroll.sources import files, store
from tillroll.staging import fresh_path

CUSTOMER = "7"
CROSS_SELL = {"bought": "5", "missing": "7"}
PERIOD_START = "1998-01-01"


# --- sources and sinks


def load_transactions(spark, folder):
    path = fresh_path(spark, "export") + ".csv"
    files.save_csv(t.lines(spark, folder), path)
    return t.plain(files.load_transactions(spark, path))


def load_awkward_csv(spark, folder):
    """A file whose descriptions hold blanks, quotes, commas, nothing, and letters beyond Latin-1."""
    kind = F.abs("Quantity") % 5
    texts = F.when(kind == 0, "  PAD  ").when(kind == 1, 'SET "15", RED').when(kind == 2, "").when(kind == 3, "\u65e5\u672c \u00e9, \u20ac")
    path = fresh_path(spark, "awkward")
    files.save_csv(t.lines(spark, folder).withColumn("Description", texts), path)
    return t.plain(files.load_transactions(spark, path, format="csv"))


def load_mixed_encodings(spark, folder):
    """Files of two encodings, some rows of which do not parse: the lines, and how many rows were put aside."""
    path = fresh_path(spark, "mixed")
    plain = t.lines(spark, folder).withColumn("Description", F.lit("CAF\u00c9"))
    even = F.pmod(F.xxhash64("Invoice", "StockCode"), F.lit(2)) == 0
    files.save_csv(plain.where(even), f"{path}/utf8")
    files.save_csv(plain.where(~even), f"{path}/latin1", encoding="ISO-8859-1")
    bad = plain.where(F.col("Quantity") < 0).withColumn("Quantity", F.concat(F.col("Quantity").cast("string"), F.lit("x")))
    files.save_csv(bad, f"{path}/bad")
    lines, put_aside = files.load_mixed(spark, f"{path}/*")
    return lines.groupBy("Description", "Country").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("Quantity").alias("units")
    ).unionByName(put_aside.groupBy(F.lit("put aside").alias("Description"), F.col("reason").alias("Country")).agg(
        F.count(F.lit(1)).alias("line_count"), F.lit(0).cast("long").alias("units")
    ))


def _periods(spark, folder):
    tx = t.lines(spark, folder)
    start = F.to_timestamp_ntz(F.lit(PERIOD_START))
    date = F.col("InvoiceDate")
    return tx.where(date < start), tx.where((date >= start) | date.isNull())


def union_periods(spark, folder):
    return t.plain(files.union_periods(*_periods(spark, folder)))


def schema_check(spark, folder):
    raw = t.lines(spark, folder).withColumnRenamed("CustomerID", "Customer ID")
    tx, valid = validate_schema(raw)
    return tx.agg(
        F.lit(valid).alias("valid"), F.count(F.lit(1)).alias("row_count"), F.count("CustomerID").alias("known_rows")
    )


def save_and_load(spark, folder):
    path = fresh_path(spark, "table")
    files.save_table(t.cleaned(spark, folder), path)
    return t.plain(files.load_table(spark, path))


def load_table(spark, folder):
    """The kept lines, as the cleaning job left them in the shared folder."""
    return t.plain(t.kept(spark, folder))


def create_transactions(spark, folder):
    files.create_transactions(t.lines(spark, folder))
    return t.plain(spark.table("transactions"))


# The two example rows.
EXAMPLE_ROWS = [
    ("489434", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER", 6, "2009-12-01 07:45:00", "2.55", "13085", "United Kingdom"),
    ("C489435", "22632", "HAND WARMER RED POLKA DOT", -1, "2009-12-01 07:46:00", "1.85", "13085", "United Kingdom"),
]


def insert_rows(spark, folder):
    rows = [(*r[:4], datetime.fromisoformat(r[4]), Decimal(r[5]), *r[6:]) for r in EXAMPLE_ROWS]
    return t.plain(files.insert_rows(t.lines(spark, folder), rows))


def _grown(spark, folder):
    """The state of all lines, put in as two batches, the second of them twice."""
    path = fresh_path(spark, "grown")
    early, late = _periods(spark, folder)
    for batch, tx in (("early", early), ("late", late), ("late", late)):
        growing.put_batch(tx, path, batch)
    return path


def growing_rfm(spark, folder):
    return t.plain(growing.rfm_metrics(spark, _grown(spark, folder)))


def growing_customer_summary(spark, folder):
    return growing.customer_summary(spark, _grown(spark, folder))


def stored_table(spark, folder):
    """All lines in the stored table, one year put in again, and some rows appended: what is read back by customer."""
    name, tx = f"lines_{uuid.uuid4().hex}", t.lines(spark, folder)
    rows = [(*r[:4], datetime.fromisoformat(r[4]), Decimal(r[5]), *r[6:]) for r in EXAMPLE_ROWS]
    store.create_store(tx, name, fresh_path(spark, "stored"), buckets=4)
    store.put_days(tx.where(F.year("InvoiceDate") == 1998), name)
    store.append_rows(spark.createDataFrame(rows, TRANSACTIONS), name)
    units = F.sum("Quantity").alias("units")
    return store.read_store(spark, name).groupBy("CustomerID").agg(F.count(F.lit(1)).alias("line_count"), units)


# --- filters and projections


def _where(condition, *columns, cancelled=None):
    return lambda spark, folder: t.plain(t.lines(spark, folder, *columns, cancelled=cancelled).where(condition()))


def _sold_and_returned():
    return [F.sum(c).alias(n) for n, c in products.sold_and_returned().items()]


def min_volume(spark, folder):
    tx = t.lines(spark, folder, "StockCode", "Quantity")
    return tx.groupBy("StockCode").agg(*_sold_and_returned()).where("sold_qty > 100")


def having_filter(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "CustomerID", cancelled=False).where(is_valid_sale())
    orders = tx.groupBy("CustomerID").agg(F.countDistinct("Invoice").alias("order_count"))
    return orders.where(F.col("order_count") == 1)


def date_window(spark, folder):
    return t.plain(features.date_window(t.lines(spark, folder), t.SPLIT, t.PREDICTION_DAYS))


def revenue_lines(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "StockCode", "Quantity", "Price")
    return t.plain(tx.withColumn("Revenue", line_revenue()))


def conditional_bucket(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "StockCode", "Quantity")
    return t.plain(tx.withColumn("size_band", basket_size(F.col("Quantity"))))


def segment_filter(spark, folder):
    return rfm.segment_filter(t.segments(spark, folder), "Champions")


def customer_filter(spark, folder):
    return t.plain(scoring.customer_lines(t.cleaned(spark, folder), CUSTOMER))


# --- joins


def join_cohort(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "InvoiceDate", "CustomerID", cancelled=False).where(is_valid_sale())
    active = tx.groupBy("CustomerID", month_start(F.col("InvoiceDate")).alias("activity_month")).agg(
        F.count(F.lit(1)).alias("line_count")
    )
    # at most one row per customer and month
    first = F.min("activity_month").over(Window.partitionBy("CustomerID"))
    dated = active.withColumn("cohort_month", first)
    return dated.withColumns({c: month_label(F.col(c)) for c in ("activity_month", "cohort_month")})


def join_seasonality(spark, folder):
    quarter4 = F.when(F.quarter("InvoiceDate") == 4, F.col("Revenue")).otherwise(0)
    return t.observed(spark, folder).groupBy("CustomerID").agg(
        total(F.col("Revenue")).alias("total_rev"), total(quarter4).alias("q4_rev")
    )


def join_midpoint(spark, folder):
    days = features.customer_days(t.times(spark, folder))
    return t.plain(days.select("CustomerID", F.col("day").cast("string").alias("day"), "revenue", "middle"))


def join_halves(spark, folder):
    times = t.times(spark, folder)
    return t.plain(features.spend_halves(times, features.customer_days(times)))


def join_features(spark, folder):
    base = t.observed(spark, folder)
    return t.plain(t.anew(spark, folder, "behaviour", lambda: features.behavioural_features(base)))


def join_rfm_behaviour(spark, folder):
    return t.feature_table(spark, folder).drop(features.TARGET)


def join_target(spark, folder):
    return t.feature_table(spark, folder).select("CustomerID", features.TARGET)


def anti_null_aware(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "CustomerID")
    buyers = tx.where(is_valid_sale()).select("CustomerID").distinct()
    cancelled = tx.where(is_cancelled() & F.col("CustomerID").isNotNull()).select("CustomerID")
    return joins.not_in(buyers, cancelled, "CustomerID")


def anti_null_in_list(spark, folder):
    """How many buyers are not in a list that holds a NULL: none, by the rule of NOT IN."""
    tx = t.lines(spark, folder, "Invoice", "CustomerID")
    buyers = tx.where(is_valid_sale()).select("CustomerID").distinct()
    cancelled = tx.where(is_cancelled()).select("CustomerID")
    left = joins.not_in(buyers, cancelled, "CustomerID").agg(F.count(F.lit(1)).alias("not_in_list"))
    listed = cancelled.agg(F.count(F.when(F.col("CustomerID").isNull(), 1)).alias("nulls_in_list"))
    return left.crossJoin(listed)


def cross_sell_strict_guest(spark, folder):
    """Guests bought the product not to have, so that nobody is a prospect; the plain rule finds some."""
    tx = t.lines(spark, folder, "StockCode", "CustomerID")
    strict = advanced.cross_sell_strict(tx, **CROSS_SELL, k=None).agg(F.count(F.lit(1)).alias("strict"))
    return strict.crossJoin(advanced.cross_sell(tx, **CROSS_SELL, k=None).agg(F.count(F.lit(1)).alias("plain")))


def scalar_cross(spark, folder):
    tx = t.lines(spark, folder, "InvoiceDate", "CustomerID")
    last = tx.groupBy("CustomerID").agg(F.max("InvoiceDate").alias("last_seen"))
    dated = ordering.with_totals(last, tx, newest=F.max("InvoiceDate"))
    days = whole_days(F.col("last_seen"), F.col("newest"))
    return dated.where(F.col("CustomerID").isNotNull()).select(
        "CustomerID", "last_seen", "newest", days.alias("days_since")
    )


def join_strategy(spark, folder):
    return rfm.join_strategy(t.segments(spark, folder)).select(
        "CustomerID", "Segment", "Description", "Marketing_Goal", "Tactical_Action", "Primary_Channel"
    )


def star_join(spark, folder):
    fact = t.cleaned(spark, folder)
    items = views.v_product_summary(t.lines(spark, folder, *views.v_product_summary.reads))
    return kpis.star_join(fact, t.segments(spark, folder, t.cleaned), items, kpis.dim_date(fact))


def profile_join(spark, folder):
    return scoring.profile_join(t.feature_table(spark, folder), t.segments(spark, folder))


# --- aggregations


def agg_basic(spark, folder):
    tx = t.lines(spark, folder, "StockCode", "Quantity", "Price").where(is_priced())
    price = F.col("Price")
    return tx.groupBy("StockCode").agg(
        F.sum("Quantity").alias("units"),
        mean(price).alias("avg_price"),
        F.min(price).cast("double").alias("min_price"),
        F.max(price).cast("double").alias("max_price"),
        F.count(F.lit(1)).alias("line_count"),
    )


def agg_distinct_sketch(spark, folder):
    """Customers and orders per month from sketches kept by day, beside the exact numbers."""
    day, month = F.to_date("InvoiceDate"), month_label(F.col("day"))
    tx = t.lines(spark, folder, "Invoice", "InvoiceDate", "CustomerID").where(F.col("InvoiceDate").isNotNull()).withColumn("day", day)
    daily = sketches.distinct_sketches(tx, ["day"], ["Invoice", "CustomerID"])
    near = sketches.distinct_estimates(daily.withColumn("year_month", month), ["year_month"], ["Invoice", "CustomerID"])
    exact = tx.groupBy(month.alias("year_month")).agg(F.countDistinct("Invoice").alias("orders"), F.countDistinct("CustomerID").alias("buyers"))
    close = lambda estimate, number: F.abs(F.col(estimate) - F.col(number)) <= F.greatest(F.lit(2), F.col(number) * 0.08)
    # five standard errors; an estimate has a bound, not a value that SQL could state
    return exact.join(near, "year_month").select(
        "year_month", "orders", "buyers", close("Invoice", "orders").alias("orders_close"), close("CustomerID", "buyers").alias("buyers_close")
    )


def agg_distinct(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "StockCode", "CustomerID")
    return tx.groupBy("StockCode").agg(
        F.countDistinct("Invoice").alias("invoices"), F.countDistinct("CustomerID").alias("buyers")
    )


def agg_conditional(spark, folder):
    return t.lines(spark, folder, "StockCode", "Quantity").groupBy("StockCode").agg(*_sold_and_returned())


def agg_two_level(spark, folder):
    return features.monthly_spend(features.customer_days(t.times(spark, folder)))


def agg_ratio(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "Quantity", "Price", "CustomerID")
    value = ratio(F.col("spend"), F.col("orders"))
    return customers.customer_spend(tx).select("CustomerID", value.alias("avg_order_value"))


def agg_share(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "Quantity", "Price", "CustomerID", "Country", cancelled=False).where(is_valid_sale())
    countries = tx.groupBy("Country").agg(F.sum(line_revenue()).alias("r"), F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # country rows
    return countries.select(
        "Country",
        percent(F.col("r"), F.sum("r").over(everything)).alias("revenue_pct"),
        percent(F.col("n"), F.sum("n").over(everything)).alias("line_pct"),
    )


def agg_histogram(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "CustomerID", cancelled=False).where(is_valid_sale())
    orders = tx.groupBy("CustomerID").agg(F.countDistinct("Invoice").alias("order_count"))
    return orders.groupBy("order_count").agg(F.count(F.lit(1)).alias("customer_count"))


def agg_first(spark, folder):
    return features.first_country(t.times(spark, folder))


def agg_named(spark, folder):
    return t.plain(rfm.rfm_base_full(t.cleaned(spark, folder)))


def exact_quantile(spark, folder):
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    return t.plain(quantiles.exact_quantiles(t.kept(spark, folder), ["Quantity", "Price"], wanted))


def bracketed_quantile(spark, folder):
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    return t.plain(sketches.bracketed_quantiles(t.kept(spark, folder), ["Quantity", "Price"], wanted))


# --- windows, order and top-k


def _orders(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "CustomerID", cancelled=False).where(is_valid_sale())
    return tx.groupBy("CustomerID").agg(F.countDistinct("Invoice").alias("order_count"))


def _spend(spark, folder):
    return customers.customer_spend(t.lines(spark, folder, "Invoice", "Quantity", "Price", "CustomerID"))


def total_spend():
    return F.col("spend").cast("double").alias("total_spend")


def w_rank(spark, folder):
    return ordering.global_rank(_orders(spark, folder), "order_count", "CustomerID", "order_rank")


def w_row_number(spark, folder):
    placed = ordering.global_row_number(_spend(spark, folder), [F.desc("spend"), F.asc("CustomerID")], "place")
    return placed.select("CustomerID", total_spend(), "place")


def w_ntile5(spark, folder):
    scored = rfm.rfm_scores(rfm.rfm_raw_sql(t.lines(spark, folder, *rfm.RFM_INPUT)), "sql")
    return scored.select("CustomerID", "Recency", "Frequency", "R_Score", "F_Score", "M_Score")


def w_lag(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "InvoiceDate", "CustomerID", cancelled=False).where(is_valid_sale())
    orders = tx.groupBy("CustomerID", "Invoice").agg(F.min("InvoiceDate").alias("bought_at"))
    return ordering.global_lag(orders, "CustomerID", ["bought_at", "Invoice"], "bought_at", "previous_at")


def w_rolling(spark, folder):
    weeks = revenue.revenue_weekly(t.lines(spark, folder, *revenue.revenue_weekly.reads))
    last3 = Window.orderBy("year_week").rowsBetween(-2, Window.currentRow)  # week rows
    return weeks.select("year_week", F.sum("total_orders").over(last3).alias("orders_3_weeks"))


def w_cumulative(spark, folder):
    # country rows; equal values share a total
    tx = t.lines(spark, folder, "Invoice", "CustomerID", "Country", cancelled=False).where(is_valid_sale())
    countries = tx.groupBy("Country").agg(F.countDistinct("CustomerID").alias("buyers"))
    running = F.sum("buyers").over(Window.orderBy(F.desc("buyers")))
    return countries.select("Country", "buyers", running.alias("running_buyers"))


def w_rank_first(spark, folder):
    base = rfm.rfm_base_full(t.cleaned(spark, folder)).select("CustomerID", "Recency")
    return ordering.global_row_number(base, [F.asc("Recency"), F.asc("CustomerID")], "recency_rank")


def w_qcut(spark, folder):
    base = rfm.rfm_base_full(t.cleaned(spark, folder)).select("CustomerID", "Frequency")
    placed = ordering.global_row_number(base, [F.asc("Frequency"), F.asc("CustomerID")], "place", "n")
    return placed.select("CustomerID", "Frequency", qcut_of_rank(F.col("place"), F.col("n"), 7).alias("bin"))


def order_by(spark, folder):
    return t.plain(_spend(spark, folder)).orderBy(F.desc("orders"), F.desc("spend"), "CustomerID")


def top_k(spark, folder):
    best = ordering.top_rows(_spend(spark, folder), [F.desc("spend"), F.asc("CustomerID")], 20)
    return best.select("CustomerID", total_spend())


def top_1_per_group(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "StockCode", "Quantity", "CustomerID", cancelled=False).where(is_valid_sale())
    units = tx.groupBy("CustomerID", "StockCode").agg(F.sum("Quantity").alias("units"))
    place = F.row_number().over(Window.partitionBy("CustomerID").orderBy(F.desc("units"), F.asc("StockCode")))
    return units.withColumn("place", place).where("place = 1").drop("place")


def global_rank(spark, folder):
    placed = ordering.global_row_number(
        _orders(spark, folder), [F.asc("order_count"), F.asc("CustomerID")], "place", "customers"
    )
    return placed


# --- sets, CTEs and views


def union_all(spark, folder):
    early, late = _periods(spark, folder)
    months = early.unionByName(late).groupBy(month_start(F.col("InvoiceDate")).alias("month"))
    counts = months.agg(F.count(F.lit(1)).alias("line_count"))
    return counts.select(month_label(F.col("month")).alias("year_month"), "line_count")


def select_distinct(spark, folder):
    tx = t.lines(spark, folder, "Invoice", "InvoiceDate", "CustomerID", cancelled=False).where(is_valid_sale())
    return tx.select("CustomerID", "Invoice", "InvoiceDate").distinct()


def drop_duplicates(spark, folder):
    tx = t.lines(spark, folder)
    return t.plain(tx.unionByName(tx.where(is_cancelled())).dropDuplicates())


def all_views(spark, folder):
    names = views.create_views(t.lines(spark, folder))
    counts = [f"SELECT '{n}' AS view_name, count(*) AS row_count FROM {n}" for n in names]
    return spark.sql(" UNION ALL ".join(counts))


# --- cleaning


def _step(step):
    return lambda spark, folder: t.plain(step(t.lines(spark, folder)))


def clean_duplicates(spark, folder):
    tx = t.lines(spark, folder)
    return t.plain(cleaning.clean_duplicates(tx.unionByName(tx)))


def winsorize(spark, folder):
    return t.plain(cleaning.winsorize(t.kept(spark, folder), 0.05, 0.95))


def winsorize_fine(spark, folder):
    """Bounds at percentiles of three digits."""
    return t.plain(cleaning.winsorize(t.kept(spark, folder), 0.013, 0.987))


def clean_all(spark, folder):
    return t.plain(cleaning.clean_all(t.lines(spark, folder)))


# --- features


def split_windows(spark, folder):
    before, after = features.split_windows(t.cleaned(spark, folder), t.SPLIT, t.PREDICTION_DAYS)
    sides = before.withColumn("side", F.lit("observation")).unionByName(after.withColumn("side", F.lit("prediction")))
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.min("InvoiceDate").alias("first_line"),
        F.max("InvoiceDate").alias("last_line"),
        total(F.col("Revenue")).alias("revenue"),
    )


def _of_invoices(job):
    return lambda spark, folder: t.plain(job(features.invoice_days(t.times(spark, folder))))


def _of_times(job):
    return lambda spark, folder: t.plain(job(t.times(spark, folder)))


def _of_days(job):
    return lambda spark, folder: t.plain(job(features.customer_days(t.times(spark, folder))))


def rfm_base(spark, folder):
    return t.plain(features.rfm_base(features.invoice_days(t.times(spark, folder)), t.SPLIT))


def revenue_growth(spark, folder):
    times = t.times(spark, folder)
    return features.revenue_growth(times, features.customer_days(times))


def target_revenue(spark, folder):
    _, after = features.split_windows(t.cleaned(spark, folder), t.SPLIT, t.PREDICTION_DAYS)
    return features.target_revenue(after)


def feature_table(spark, folder):
    base = t.sold(spark, folder)
    return t.anew(spark, folder, "feature-table", lambda: features.feature_table(base, t.SPLIT, t.PREDICTION_DAYS))


def _scaled_test(method):
    """The test customers in the units of the training ones."""

    def run(spark, folder):
        columns = ["Recency", "Frequency", "Monetary", "Is_UK"]
        train, test = t.split(spark, folder)
        out = features.apply_scaler(test, features.fit_scaler(train, columns, method))
        return out.select("CustomerID", *[rounded(F.col(c), 6).alias(c) for c in columns])

    return run


def _scaled(method):
    def run(spark, folder):
        columns = ["Recency", "Frequency", "Monetary", "Is_UK"]
        out = features.scale(t.feature_table(spark, folder), columns, method)
        return out.select("CustomerID", *[rounded(F.col(c), 6).alias(c) for c in columns])

    return run


# --- segments


def rfm_scores_ntile(spark, folder):
    return rfm.shown(rfm.rfm_scores(rfm.rfm_raw_sql(t.lines(spark, folder, *rfm.RFM_INPUT)), "sql"))


def rfm_scores_qcut(spark, folder):
    return rfm.shown(rfm.rfm_scores(rfm.rfm_base_full(t.cleaned(spark, folder))))


def rfm_summary_sql(spark, folder):
    return rfm.rfm_summary(rfm.segments_sql(t.lines(spark, folder, *rfm.RFM_INPUT)), "sql")


def rfm_full(spark, folder):
    segments, summary = rfm.rfm_full(t.cleaned(spark, folder))
    return segments.join(F.broadcast(summary.select("Segment", "Customer_Count")), "Segment").select(
        "CustomerID", "RFM_Score", "Segment", "Customer_Count"
    )


def validate_rfm_input(spark, folder):
    base = rfm.rfm_base_full(t.cleaned(spark, folder)).withColumnRenamed("CustomerID", "Customer ID")
    return t.plain(rfm.validate_rfm_input(base))


def segment_strategy(spark, folder):
    """The playbook with the size of each segment it applies to."""
    counts = rfm.segment_counts(t.segments(spark, folder))
    return rfm.segment_strategy(spark).join(counts, "Segment", "left").withColumn(
        "Customer_Count", F.coalesce("Customer_Count", F.lit(0).cast("bigint"))
    )


# --- measures


def _measure(*names):
    return lambda spark, folder: kpis.kpi(t.cleaned(spark, folder), *names)


def _of_cleaned(job):
    return lambda spark, folder: t.plain(job(t.cleaned(spark, folder)))


def _predicted(column):
    def run(spark, folder):
        return kpis.kpi_predicted(t.stand_in(spark, folder)).select(rounded(F.col(column), 2).alias(column))

    return run


def kpi_ltv_cac(spark, folder):
    out = kpis.kpi_ltv_cac(t.stand_in(spark, folder))
    return out.withColumn("ltv_to_cac", rounded(F.col("ltv_to_cac"), 4))


def dim_date(spark, folder):
    return kpis.dim_date(t.cleaned(spark, folder)).withColumn("Date", F.col("Date").cast("string"))


def dim_customers(spark, folder):
    summary = views.v_customer_summary(t.lines(spark, folder, *views.v_customer_summary.reads))
    return kpis.dim_customers(summary, t.segments(spark, folder))


def _kpi_by(*by):
    def run(spark, folder):
        fact = t.cleaned(spark, folder)
        facts = kpis.customer_facts(fact, t.stand_in(spark, folder))
        out = kpis.kpi_by(kpis.with_dimensions(fact, t.segments(spark, folder, t.cleaned)), list(by), customers=facts)
        digits = {"total_predicted_cltv": 2, "avg_predicted_cltv": 2, "ltv_to_cac": 4}
        return out.withColumns({c: rounded(F.col(c), d) for c, d in digits.items()})

    return run


def kpi_overview(spark, folder):
    scored = t.stand_in(spark, folder)
    out = kpis.kpi_overview(scored, t.segments(spark, folder), scored)
    exact = {"total_customers", "retention_pct"}
    return out.select(*[F.col(c) if c in exact else rounded(F.col(c), 2).alias(c) for c in out.columns])


# --- models


# The models that are saved and loaded.
FITTED = ["LinearRegression", "DecisionTree", "RandomForest"]


def daily_run(spark, folder):
    """All result tables of one run, with their sizes."""
    out = fresh_path(spark, "daily")
    tables = daily.daily_run(
        t.lines(spark, folder), out, t.SPLIT, t.PREDICTION_DAYS
    )
    counts = [
        spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, path in tables.items()
    ]
    return files.union_periods(*counts)


def train_test_split(spark, folder):
    return modelling.with_split(t.feature_table(spark, folder)).select("CustomerID", "split")


# Fewer trees than the default of 100.
BOOSTED = {"XGBoost": {"maxIter": 10}}


def _model(name):
    """Untuned fit of one model, its metrics on the test customers."""

    def run(spark, folder):
        train, test = t.split(spark, folder)
        return modelling.evaluate([modelling.train_model(train, name, tune=False, **BOOSTED.get(name, {}))], test)

    return run


def random_search_cv(spark, folder):
    train, _ = t.split(spark, folder)
    _, settings, fitted = modelling.random_search(train, "DecisionTree", n_iter=10, folds=5)
    return modelling.search_results(spark, settings, fitted)


def model_comparison(spark, folder):
    train, test = t.split(spark, folder)
    return modelling.evaluate(modelling.train_all(train, tune=False), test)


# Simple predictors from the features, to rank and register without a fit.
SIMPLE = {"Monthly": "Avg_Monthly_Spend", "Order": "Avg_Order_Value", "History": "Monetary"}


def _simple_metrics(spark, folder):
    table = t.feature_table(spark, folder)
    return modelling.compare([
        modelling.metrics(table, column).select(
            F.lit(name).alias("Model"), *[rounded(F.col(m), 4).alias(m) for m in ("MAE", "RMSE", "R2", "MAPE")]
        )
        for name, column in SIMPLE.items()
    ])


def metrics_regression(spark, folder):
    out = modelling.metrics(t.stand_in(spark, folder), scoring.PREDICTED)
    return out.select(*[rounded(F.col(c), 4).alias(c) for c in out.columns])


def model_registry(spark, folder):
    path = fresh_path(spark, "registry")
    for row in _simple_metrics(spark, folder).collect():  # three rows
        for _ in range(2):  # the second entry replaces the first
            modelling.register(spark, path, row["Model"], f"models/{row['Model']}", row.asDict())
    entries = modelling.read_registry(spark, path)
    best = modelling.best_model(entries).select(F.col("name").alias("best_model"))
    current = modelling.current_models(entries).select("name", "path", "MAE", "RMSE", "R2", "MAPE")
    return current.crossJoin(F.broadcast(best))


def _saved_models(spark, train, test):
    path = fresh_path(spark, "models")
    for name in FITTED:
        trained = modelling.train_model(train, name, tune=False)
        row = modelling.evaluate([trained], test).first()
        modelling.save_model(trained, path, row.asDict())
    return path


def save_model(spark, folder):
    path = _saved_models(spark, *t.split(spark, folder))
    return modelling.current_models(modelling.read_registry(spark, f"{path}/registry")).drop("path")


def load_best(spark, folder):
    train, test = t.split(spark, folder)
    name, model = modelling.load_best(spark, _saved_models(spark, train, test))
    return scoring.score_batch(model, test).select("CustomerID", scoring.PREDICTED, F.lit(name).alias("model"))


def _linear(spark, folder):
    train, test = t.split(spark, folder)
    return modelling.train_model(train, "LinearRegression", tune=False).model, test


def feature_importance(spark, folder):
    train, _ = t.split(spark, folder)
    trained = modelling.train_model(train, "RandomForest", tune=False)
    return modelling.feature_importance(spark, trained.model)


def residuals(spark, folder):
    model, test = _linear(spark, folder)
    return modelling.residuals(model.transform(test))


def residuals_stand_in(spark, folder):
    return modelling.residuals(t.stand_in(spark, folder), scoring.PREDICTED)


# Fits on a target that is a rule of two features: what a model finds and predicts can then be said in SQL.


def _ruled(spark, folder):
    rule = F.col("Recency") * 2.0 + F.col("Frequency") * 5.0 + 7.0
    table = t.feature_table(spark, folder).withColumn(TARGET, rule)
    return table, *modelling.train_test_split(table)


def _ruled_model(spark, folder):
    table, train, test = _ruled(spark, folder)
    return modelling.train_model(train, "LinearRegression", tune=False), table, test


def model_linear_rule(spark, folder):
    trained, _, test = _ruled_model(spark, folder)
    out = modelling.evaluate([trained], test)
    return out.select("Model", *[rounded(F.col(m), 4).alias(m) for m in ("MAE", "RMSE", "R2", "MAPE")])


# Few trees with large steps find a step; the defaults' least rows of a child would be more than the home customers of a small table.
STEP_SETTINGS = {
    "DecisionTree": {},
    "GradientBoosting": {"maxIter": 3},
    "XGBoost": {"maxIter": 10, "stepSize": 0.9, "regLambda": 0.0},
    "LightGBM": {"maxIter": 10, "stepSize": 0.9, "minChildRows": 1},
}


def _step_rule(name):
    """A model fitted to a step of one feature predicts it for the test customers."""

    def run(spark, folder):
        step = F.when(F.col("Is_UK") == 1, 140.0).otherwise(40.0)
        train, test = modelling.train_test_split(t.feature_table(spark, folder).withColumn(TARGET, step))
        trained = modelling.train_model(train, name, tune=False, **STEP_SETTINGS[name])
        out = modelling.residuals(trained.model.transform(test))
        return out.select("CustomerID", *[rounded(F.col(c), 4).alias(c) for c in ("actual", "predicted", "residual")])

    return run


def feature_importance_rule(spark, folder):
    trained, _, _ = _ruled_model(spark, folder)
    out = modelling.feature_importance(spark, trained.model)
    return out.select("Feature", rounded(F.col("Importance"), 4).alias("Importance"))


def score_batch_rule(spark, folder):
    trained, table, _ = _ruled_model(spark, folder)
    out = scoring.score_batch(trained.model, table)
    return out.select("CustomerID", rounded(F.col(scoring.PREDICTED), 4).alias(scoring.PREDICTED))


def score_whatif_rule(spark, folder):
    trained, table, _ = _ruled_model(spark, folder)
    out = scoring.score_whatif(trained.model, table, Recency=1, Frequency=F.col("Frequency") + 1)
    return out.select("CustomerID", rounded(F.col(scoring.PREDICTED), 4).alias(scoring.PREDICTED))


def residuals_rule(spark, folder):
    trained, _, test = _ruled_model(spark, folder)
    out = modelling.residuals(trained.model.transform(test))
    return out.select("CustomerID", *[rounded(F.col(c), 4).alias(c) for c in ("actual", "predicted", "residual")])


def load_best_rule(spark, folder):
    """The saved model with the best score is the one that found the rule."""
    table, train, test = _ruled(spark, folder)
    name, model = modelling.load_best(spark, _saved_models(spark, train, test))
    out = scoring.score_batch(model, table)
    return out.select("CustomerID", rounded(F.col(scoring.PREDICTED), 4).alias(scoring.PREDICTED), F.lit(name).alias("model"))


def permutation_importance(spark, folder):
    return modelling.permutation_importance(*_linear(spark, folder))


def score_batch(spark, folder):
    model, _ = _linear(spark, folder)
    return scoring.score_batch(model, t.feature_table(spark, folder)).select("CustomerID", scoring.PREDICTED)


def score_whatif(spark, folder):
    model, _ = _linear(spark, folder)
    everyone = t.feature_table(spark, folder)
    out = scoring.score_whatif(model, everyone, Recency=1, Frequency=F.col("Frequency") + 1)
    return out.select("CustomerID", "Recency", "Frequency", scoring.PREDICTED)


def cac_tier_threshold(spark, folder):
    return scoring.cac_tier_threshold(t.stand_in(spark, folder))


def cac_tier_percentile(spark, folder):
    return scoring.cac_tier_percentile(t.stand_in(spark, folder))


def attribution_local(spark, folder):
    out = scoring.attribution_local(t.stand_in(spark, folder))
    return out.select("CustomerID", *[rounded(F.col(c), 3).alias(c) for c in out.columns[1:]])


def customer_profile(spark, folder):
    return scoring.customer_profile(t.stand_in(spark, folder), t.segments(spark, folder))


def customer_timeline(spark, folder):
    return scoring.customer_timeline(t.cleaned(spark, folder), CUSTOMER)


def cltv_traditional(spark, folder):
    churn = kpis.kpi_churn_rate(t.cleaned(spark, folder))
    base = t.feature_table(spark, folder).crossJoin(F.broadcast(churn))
    out = scoring.cltv_traditional(base, F.col("churn_rate"))
    return out.withColumn("cltv", rounded(F.col("cltv"), 4))


def cltv_discounted(spark, folder):
    out = scoring.cltv_discounted(t.feature_table(spark, folder))
    return out.withColumn("cltv", rounded(F.col("cltv"), 4))


QUERIES: dict[str, t.Query] = {
    # sources and sinks
    "load_transactions": load_transactions,
    "load_awkward_csv": load_awkward_csv,
    "load_mixed_encodings": load_mixed_encodings,
    "union_periods": union_periods,
    "validate_schema": schema_check,
    "table_profile": lambda spark, folder: profile.table_profile(t.lines(spark, folder)),
    "save_table": save_and_load,
    "load_table": load_table,
    "create_transactions": create_transactions,
    "insert_rows": insert_rows,
    "stored_table": stored_table,
    "growing_rfm": growing_rfm,
    "growing_customer_summary": growing_customer_summary,
    # filters and projections
    "valid_sales": _where(is_valid_sale),
    "positive_price": _where(is_priced, "Invoice", "StockCode", "Quantity", "Price"),
    "cancellations_only": _where(is_cancelled, "Invoice", "StockCode", "Quantity", cancelled=True),
    "exclude_home_market": _where(is_abroad, "Invoice", "StockCode", "CustomerID", "Country"),
    "min_volume": min_volume,
    "having_filter": having_filter,
    "date_window": date_window,
    "line_revenue": revenue_lines,
    "conditional_bucket": conditional_bucket,
    "segment_filter": segment_filter,
    "customer_filter": customer_filter,
    # joins
    "join_cohort": join_cohort,
    "join_seasonality": join_seasonality,
    "join_midpoint": join_midpoint,
    "join_halves": join_halves,
    "join_features": join_features,
    "join_rfm_behaviour": join_rfm_behaviour,
    "join_target": join_target,
    "anti_null_aware": anti_null_aware,
    "anti_null_in_list": anti_null_in_list,
    "scalar_cross": scalar_cross,
    "join_strategy": join_strategy,
    "star_join": star_join,
    "profile_join": profile_join,
    # aggregations
    "agg_basic": agg_basic,
    "agg_distinct": agg_distinct,
    "agg_distinct_sketch": agg_distinct_sketch,
    "agg_conditional": agg_conditional,
    "agg_two_level": agg_two_level,
    "agg_ratio": agg_ratio,
    "agg_share": agg_share,
    "agg_histogram": agg_histogram,
    "agg_first": agg_first,
    "agg_named": agg_named,
    "value_counts": lambda spark, folder: rfm.segment_counts(t.segments(spark, folder)),
    "exact_quantile": exact_quantile,
    "bracketed_quantile": bracketed_quantile,
    # windows, order, top-k
    "w_rank": w_rank,
    "w_row_number": w_row_number,
    "w_ntile4": t.on_lines(revenue.revenue_quartiles),
    "w_ntile5": w_ntile5,
    "w_lag": w_lag,
    "w_rolling": w_rolling,
    "w_cumulative": w_cumulative,
    "w_rank_first": w_rank_first,
    "w_qcut": w_qcut,
    "order_by": order_by,
    "top_k": top_k,
    "top_1_per_group": top_1_per_group,
    "global_rank": global_rank,
    # sets, CTEs, views
    "union_all": union_all,
    "select_distinct": select_distinct,
    "drop_duplicates": drop_duplicates,
    "cte_chain": rfm_summary_sql,
    "derived_table": t.on_lines(revenue.revenue_avg_daily),
    "views": all_views,
    # cleaning
    "clean_missing_customer": _step(cleaning.clean_missing_customer),
    "clean_cancelled": _step(cleaning.clean_cancelled),
    "clean_quantity": _step(cleaning.clean_quantity),
    "clean_price": _step(cleaning.clean_price),
    "clean_types": _step(cleaning.clean_types),
    "clean_duplicates": clean_duplicates,
    "clean_test_accounts": _step(cleaning.clean_test_accounts),
    "winsorize": winsorize,
    "winsorize_fine": winsorize_fine,
    "clean_description": _step(cleaning.clean_description),
    "add_revenue": _of_cleaned(lambda df: df.select("Invoice", "StockCode", "Quantity", "Price", "Revenue")),
    "cleaning_report": lambda spark, folder: cleaning.cleaning_report(t.lines(spark, folder)),
    "clean_all": clean_all,
    # features
    "split_windows": split_windows,
    "rfm_base": rfm_base,
    "product_diversity": lambda spark, folder: features.product_diversity(t.observed(spark, folder)),
    "avg_basket_size": _of_invoices(lambda df: features.basket_means(df).drop("Avg_Order_Value")),
    "avg_order_value": _of_invoices(lambda df: features.basket_means(df).drop("Avg_Basket_Size")),
    "avg_monthly_spend": _of_days(features.monthly_spend),
    "seasonal_score_q4": _of_days(features.seasonal_score),
    "avg_purchase_interval": _of_invoices(features.purchase_interval),
    "revenue_growth": revenue_growth,
    "is_uk": _of_times(features.is_uk),
    "behavioural_features": join_features,
    "feature_table": feature_table,
    "target_revenue": target_revenue,
    "returning_rate": lambda spark, folder: features.returning_rate(t.feature_table(spark, folder)),
    "scale_standard": _scaled("standard"),
    "scale_minmax": _scaled("minmax"),
    "scale_test_standard": _scaled_test("standard"),
    "scale_test_minmax": _scaled_test("minmax"),
    # segments
    "rfm_raw_sql": lambda spark, folder: t.plain(rfm.rfm_raw_sql(t.lines(spark, folder, *rfm.RFM_INPUT))),
    "rfm_scores_ntile": rfm_scores_ntile,
    "rfm_base_full": agg_named,
    "rfm_scores_qcut": rfm_scores_qcut,
    "rfm_segments": lambda spark, folder: rfm.shown(t.segments(spark, folder)),
    "rfm_summary_sql": rfm_summary_sql,
    "rfm_summary": lambda spark, folder: rfm.rfm_summary(t.segments(spark, folder)),
    "segment_strategy": segment_strategy,
    "rfm_full": rfm_full,
    "validate_rfm_input": validate_rfm_input,
    # revenue
    **{
        job.__name__: t.on_lines(job)
        for job in (
            revenue.revenue_totals,
            revenue.revenue_monthly,
            revenue.revenue_weekly,
            revenue.revenue_top_months,
            revenue.revenue_yearly,
            revenue.revenue_avg_daily,
            revenue.revenue_quartiles,
            customers.customers_total,
            customers.customers_top_spend,
            customers.customers_frequency_dist,
            customers.customers_aov,
            customers.customers_repeat_rate,
            customers.customers_cohorts,
            customers.customers_lifetime,
            customers.customers_active,
            customers.customers_pareto,
            products.products_top_revenue,
            products.products_top_units,
            products.products_most_returned,
            products.products_price_stats,
            products.products_diversity,
            products.products_best_by_country,
            products.products_return_rate,
            advanced.adv_rolling_3m,
            advanced.adv_mom_growth,
            advanced.adv_purchase_gaps,
            advanced.adv_country_cumulative,
            advanced.adv_top_product_per_customer,
            advanced.adv_basket_sizes,
            advanced.adv_quarterly,
            views.v_customer_summary,
            views.v_monthly_revenue,
            views.v_rfm_segments,
            views.v_product_summary,
        )
    },
    # the fixture has no product with a single buyer
    "products_single_buyer": t.on_lines(products.products_single_buyer, buyers=20),
    "cross_sell": t.on_lines(advanced.cross_sell, **CROSS_SELL),
    "cross_sell_strict": t.on_lines(advanced.cross_sell_strict, bought="5", missing="68"),
    "cross_sell_strict_guest": cross_sell_strict_guest,
    "eda_monthly_trend": _of_cleaned(kpis.eda_monthly_trend),
    "eda_top_countries": _of_cleaned(kpis.eda_top_countries),
    # measures
    "kpi_net_sales": _measure("net_sales"),
    "kpi_customers": _measure("unique_customers"),
    "kpi_orders": _measure("total_orders"),
    "kpi_aov": _measure("average_order_value"),
    "kpi_frequency": _measure("purchase_frequency"),
    "kpi_cac": _of_cleaned(kpis.kpi_cac),
    "kpi_predicted_total": _predicted("total_predicted_cltv"),
    "kpi_predicted_avg": _predicted("avg_predicted_cltv"),
    "kpi_ltv_cac": kpi_ltv_cac,
    "kpi_repeat_rate": _of_cleaned(kpis.kpi_repeat_rate),
    "kpi_churn_rate": _of_cleaned(kpis.kpi_churn_rate),
    "dim_date": dim_date,
    "dim_customers": dim_customers,
    "dim_products": t.on_lines(views.v_product_summary),
    "kpi_by": _kpi_by("Country"),
    "kpi_by_segment": _kpi_by("Segment"),
    "kpi_by_quarter": _kpi_by("Year", "Quarter"),
    "kpi_by_product": _kpi_by("StockCode"),
    "kpi_overview": kpi_overview,
    # models and scoring
    "daily_run": daily_run,
    "train_test_split": train_test_split,
    "model_linear": _model("LinearRegression"),
    "model_tree": _model("DecisionTree"),
    "model_forest": _model("RandomForest"),
    "model_gbt": _model("GradientBoosting"),
    "model_xgb": _model("XGBoost"),
    "model_lgbm": _model("LightGBM"),
    "model_tree_rule": _step_rule("DecisionTree"),
    "model_gbt_rule": _step_rule("GradientBoosting"),
    "model_xgb_rule": _step_rule("XGBoost"),
    "model_lgbm_rule": _step_rule("LightGBM"),
    "random_search_cv": random_search_cv,
    "train_all": model_comparison,
    "metrics_regression": metrics_regression,
    "model_comparison": _simple_metrics,
    "model_registry": model_registry,
    "save_model": save_model,
    "load_best": load_best,
    "feature_importance": feature_importance,
    "residuals": residuals_stand_in,
    "residuals_linear": residuals,
    "permutation_importance": permutation_importance,
    "score_batch": score_batch,
    "model_linear_rule": model_linear_rule,
    "feature_importance_rule": feature_importance_rule,
    "score_batch_rule": score_batch_rule,
    "score_whatif_rule": score_whatif_rule,
    "residuals_rule": residuals_rule,
    "load_best_rule": load_best_rule,
    "score_whatif": score_whatif,
    "cac_tier_threshold": cac_tier_threshold,
    "cac_tier_percentile": cac_tier_percentile,
    "attribution_local": attribution_local,
    "segment_counts": lambda spark, folder: rfm.segment_counts(t.segments(spark, folder)),
    "segment_spend": lambda spark, folder: rfm.segment_spend(t.segments(spark, folder)),
    "customer_profile": customer_profile,
    "customer_timeline": customer_timeline,
    "cltv_traditional": cltv_traditional,
    "cltv_discounted": cltv_discounted,
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Segment summary of all customers, straight from the lines."""
    return rfm_summary_sql(spark, folder)
