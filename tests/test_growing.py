"""Figures kept by batches equal those of a full run, and a new batch reads no old lines."""

from conftest import SMALL
from pyspark.sql import functions as F

from tillroll.catalog import tables
from tillroll.plans import growing, rfm, views


def text(frame, columns):
    return sorted(map(str, frame.select(*columns).collect()))


def same_as_whole(spark, folder, tx):
    for ours, whole in ((growing.customer_summary(spark, folder), views.v_customer_summary(tx)), (growing.rfm_metrics(spark, folder), rfm.rfm_raw_sql(tx))):
        assert ours.columns == whole.columns
        cast = [F.col(c).cast("decimal(38,2)") if c == "Monetary" else F.col(c) for c in whole.columns]
        assert text(ours, cast) == text(whole, cast)


def test_batches_add_up(spark, tmp_path):
    tx, folder = tables.lines(spark, SMALL), str(tmp_path / "state")
    part = F.pmod(F.xxhash64("Invoice", "StockCode"), F.lit(3))  # invoices span batches
    for batch in (0, 1):
        growing.put_batch(tx.where(part == batch), folder, str(batch))
    same_as_whole(spark, folder, tx.where(part < 2))
    for _ in range(2):
        growing.put_batch(tx.where(part == 2), folder, "2")
        same_as_whole(spark, folder, tx)
    growing.put_batch(tx.where(part == 2).limit(0), folder, "2")
    same_as_whole(spark, folder, tx.where(part < 2))


def test_countries_guests_and_empty_figures(spark, lines, tmp_path):
    folder = str(tmp_path / "state")
    first = lines(("1", "A", 2, "2011-01-01", 5, "1"), ("C2", "A", -2, "2011-05-01", 5, "1"), ("3", "B", 1, "2011-01-03", 5, None))
    more = lines(("1", "B", 1, "2011-01-02", 5, "1", "France"), ("4", "B", 1, "2011-01-04", 5, "2", None))
    unpriced = more.withColumn("Price", F.when(F.col("CustomerID") == "1", F.col("Price")))
    growing.put_batch(first, folder, "2011-01-01")
    growing.put_batch(unpriced, folder, "2011-01-02")
    same_as_whole(spark, folder, first.unionByName(unpriced))


def test_a_batch_reads_its_own_lines_only(spark, lines, tmp_path):
    folder = str(tmp_path / "state")
    for day in ("2011-01-01", "2011-01-02"):
        path = str(tmp_path / day)
        lines(("1", "A", 1, day, 5, "1")).write.parquet(path)
        growing.put_batch(spark.read.parquet(path), folder, day)
    read = {f.rsplit("/", 2)[1] for f in growing.rfm_metrics(spark, folder).inputFiles()}
    assert read == {"batch=2011-01-01", "batch=2011-01-02"}  # the state alone
