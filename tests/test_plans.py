"""The plans Spark makes: what is scanned, pushed down, shuffled and limited."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.catalog import tables
from tillroll.plans import features
from tillroll.sources import files

QUERIES = entry.queries()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column: str) -> list[str]:
    """Scans that read ``column``."""
    return [line for line in executed(df).splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("name", [
    "revenue_totals", "revenue_monthly", "revenue_weekly", "customers_frequency_dist", "customers_cohorts",
    "customers_top_spend", "products_top_revenue", "products_best_by_country", "v_product_summary",
    "adv_purchase_gaps", "cross_sell", "cleaning_report", "adv_country_cumulative", "adv_basket_sizes", "table_profile",
])
def test_one_pass_over_the_lines(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    assert len(re.findall(r"FileScan parquet \[[^\]]*(l_partkey|l_orderkey|Invoice#|Revenue#|Quantity#)", plan)) == 1


def test_only_needed_columns_are_read(spark):
    lines = scans(QUERIES["customers_total"](spark, SMALL), "l_orderkey")
    assert len(lines) == 1
    assert "l_quantity" not in lines[0] and "l_returnflag" not in lines[0]


def test_date_filters_reach_the_scan(spark, lines, tmp_path):
    path = str(tmp_path / "lines.parquet")
    files.save_table(lines(("1", "A", 1, "2011-01-01", 5, "1")), path)
    window = features.date_window(files.load_table(spark, path), "2011-01-01", 90).select("Invoice")
    plan = window._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(InvoiceDate" in pushed and "LessThan(InvoiceDate" in pushed
    assert "ReadSchema: struct<Invoice:string,InvoiceDate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["w_row_number", "global_rank", "w_rank", "w_lag", "customers_pareto", "cac_tier_percentile"])
def test_no_window_over_all_customers(spark, name):
    """Ranking functions of the whole table are computed from range partitions."""
    plan = executed(QUERIES[name](spark, SMALL))
    for line in plan.splitlines():
        if "Window [" in line and "_part" not in line:
            # what is left are totals over two tiers or over the partitions' own counts
            assert "row_number" not in line and "rank(" not in line and "ntile" not in line and "lag(" not in line
    assert "_part" in plan


@pytest.mark.parametrize("name", ["rfm_scores_ntile", "rfm_scores_qcut", "v_rfm_segments"])
def test_scores_order_single_buckets_only(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    windows = [line for line in plan.splitlines() if re.search(r"Window \[.*(row_number|rank\(|ntile|lag\()", line)]
    assert windows and all(re.search(r"\[name#\d+, bucket#\d+\]", line) for line in windows)
    staged = {m.group(1) for f in QUERIES[name](spark, SMALL).inputFiles() if (m := re.search(r"/tillroll/[^/]+/([a-z-]+)-[0-9a-f]{32}/", f))}
    assert staged <= {"lines", "bounds"}  # the cleaned lines that all queries share, and no table of customers or cuts


@pytest.mark.parametrize("name", ["top_1_per_group", "adv_top_product_per_customer", "products_best_by_country"])
def test_top_1_is_limited_before_the_shuffle(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["customers_aov", "products_top_units", "top_k", "segment_filter"])
def test_top_k_keeps_k_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in executed(QUERIES[name](spark, SMALL))


def test_totals_are_broadcast_as_one_row(spark):
    frame = QUERIES["customers_active"](spark, SMALL)
    nested = [line for line in executed(frame).splitlines() if "BroadcastNestedLoopJoin" in line]
    assert len(nested) == 1
    assert frame.agg(F.count(F.lit(1))).first()[0] == 2


@pytest.mark.parametrize("name", ["revenue_monthly", "cancellations_only", "customers_top_spend", "revenue_quartiles"])
def test_the_cancellation_flag_reaches_the_scan(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    pushed = next(re.search(r"PushedFilters: \[([^\]]*)", line).group(1) for line in plan.splitlines() if "FileScan" in line and "l_returnflag" in line)
    assert "l_returnflag" in pushed and "l_linestatus" in pushed
    assert "REPARTITION" not in plan


@pytest.mark.parametrize("name", ["customers_active", "kpi_churn_rate", "scalar_cross", "cross_sell_strict", "rfm_raw_sql", "rfm_scores_ntile", "rfm_summary_sql", "v_rfm_segments", "views"])
def test_building_a_frame_runs_no_query(spark, name):
    tables.cleaned(spark, SMALL)  # a staged run of its own
    before = spark._jsc.sc().dagScheduler().nextJobId()
    frame = QUERIES[name](spark, SMALL)
    started = spark._jsc.sc().dagScheduler().nextJobId() - before
    assert frame.columns and started <= 5  # schemas, and whether the staged tables are still those of their input


def test_prospects_are_counted_without_a_limit(spark):
    plan = executed(QUERIES["cross_sell_strict_guest"](spark, SMALL))
    assert "Limit" not in plan and "TakeOrdered" not in plan and "Sort " not in plan
