"""The stored table: layout, days put in once and again, what a filter reads and what an aggregate shuffles."""

import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillroll.catalog import tables
from tillroll.sources import store


def text(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture
def lines_and_table(spark, tmp_path):
    tx = tables.lines(spark, SMALL).where("InvoiceDate >= '1998-01-01' AND InvoiceDate < '1998-04-01'").cache()
    store.create_store(tx, "stored_lines", str(tmp_path / "stored"), buckets=4)
    yield tx, str(tmp_path / "stored")
    spark.sql("DROP TABLE IF EXISTS stored_lines")
    tx.unpersist()


def test_days_are_replaced_and_appended(spark, lines_and_table, lines):
    tx, path = lines_and_table
    assert text(store.read_store(spark, "stored_lines")) == text(tx)
    assert {f"month=1998-0{m}" for m in (1, 2, 3)} <= set(os.listdir(path))
    day = tx.where("to_date(InvoiceDate) = '1998-02-03'")
    for _ in range(2):  # putting a day in again changes nothing
        store.put_days(day, "stored_lines")
        assert text(store.read_store(spark, "stored_lines")) == text(tx)
    fewer = spark.createDataFrame(day.limit(1).collect(), day.schema)
    fresh = lines(("900", "A", 2, "1998-05-06 07:08:09", 5, "1"), ("901", "B", 1, "1998-05-06 08:00:00", 5, None))
    store.put_days(fewer.unionByName(fresh), "stored_lines")
    want = tx.where("to_date(InvoiceDate) <> '1998-02-03'").unionByName(fewer).unionByName(fresh)
    assert text(store.read_store(spark, "stored_lines")) == text(want)
    store.append_rows(fresh, "stored_lines")
    undated = fresh.withColumn("InvoiceDate", F.lit(None).cast("timestamp_ntz"))
    store.put_days(undated, "stored_lines")
    assert text(store.read_store(spark, "stored_lines")) == text(want.unionByName(fresh).unionByName(undated))


def test_a_month_is_read_from_its_folders(spark, lines_and_table):
    tx, _ = lines_and_table
    month = store.read_store(spark, "stored_lines", "1998-02")
    assert text(month) == text(tx.where("date_format(InvoiceDate, 'yyyy-MM') = '1998-02'"))
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "1998-02" in scan
    assert {f.split("month=")[1][:7] for f in month.inputFiles()} >= {"1998-02"}


def test_an_aggregate_by_customer_is_not_shuffled(spark, lines_and_table):
    tx, _ = lines_and_table
    spend = store.read_store(spark, "stored_lines").groupBy("CustomerID").agg(F.sum("Quantity").alias("units"))
    assert "Exchange" not in spend._jdf.queryExecution().executedPlan().toString()
    assert text(spend) == text(tx.groupBy("CustomerID").agg(F.sum("Quantity").alias("units")))
