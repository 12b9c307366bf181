"""Customer figures that grow by batches of lines: a new day is read once, and the days before it never again.

The state lies in a folder, in three tables with a folder per batch: partial sums by customer and country, the different
invoices by customer and country, and one row with the newest date of all lines. Putting a batch in again replaces it, so a
repeated run changes nothing. What is read back is what a full run over all batches' lines gives: sums are exact decimals,
and an invoice that spans batches counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.functions.dates import whole_days
from tillroll.functions.money import line_revenue, ratio
from tillroll.functions.rules import is_valid_sale
from tillroll.operators.ordering import with_totals

_KEY = ["CustomerID", "Country"]
_TABLES = ("sums", "invoices", "newest")


def put_batch(tx: DataFrame, folder: str, batch: str) -> None:
    """Put in the lines ``tx`` under a label of the caller's choice, a day for instance."""
    sales = tx.where(is_valid_sale())
    revenue = line_revenue()
    tables = {
        "sums": sales.groupBy(*_KEY).agg(
            F.min("InvoiceDate").alias("first"),
            F.max("InvoiceDate").alias("last"),
            F.sum("Quantity").alias("units"),
            F.sum(revenue).alias("revenue"),
            F.count(revenue).alias("priced"),
        ),
        "invoices": sales.select(*_KEY, "Invoice").distinct(),
        "newest": tx.agg(F.max("InvoiceDate").alias("newest")),
    }
    for name, table in tables.items():
        labelled = table.withColumn("batch", F.lit(batch))
        labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{folder}/{name}")
        if table.isEmpty():  # nothing is written for a batch without sales, so what there was of it has to go
            path = tx.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/batch={batch}")
            path.getFileSystem(tx.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _merged(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The figures of all batches by ``keys``: as many rows as the state has, not as many as there are lines."""
    sums, invoices, _ = (spark.read.parquet(f"{folder}/{name}") for name in _TABLES)
    held = sums.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced"),
    )
    counts = invoices.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.countDistinct("Invoice").alias("orders"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return held.join(counts, same, "left").drop(*[f"_{k}" for k in keys])


def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    """As ``views.v_customer_summary`` over all lines put in."""
    held = _merged(spark, folder, _KEY)
    return held.select(
        *_KEY,
        F.col("first").alias("first_purchase_date"),
        F.col("last").alias("last_purchase_date"),
        F.col("orders").alias("total_orders"),
        F.col("units").alias("total_items_bought"),
        F.col("revenue").cast("double").alias("total_revenue_spend"),
        ratio(F.col("revenue"), F.col("priced")).alias("avg_item_revenue"),
        ratio(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
    )


def rfm_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """As ``rfm.rfm_raw_sql`` over all lines put in; the newest date is that of all lines, guests and cancellations included."""
    newest = spark.read.parquet(f"{folder}/newest")
    dated = with_totals(_merged(spark, folder, ["CustomerID"]), newest, newest=F.max("newest")).where(F.col("last").isNotNull())
    recency = whole_days(F.col("last"), F.col("newest")).alias("Recency")
    return dated.select("CustomerID", recency, F.col("orders").alias("Frequency"), F.col("revenue").alias("Monetary"))
