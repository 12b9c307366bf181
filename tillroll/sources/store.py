"""A stored table of lines that grows by days: laid out for filters by month and for aggregates by customer.

The lines lie in a folder per month, bucketed by customer. A filter on the month reads one month's folder, and an aggregate
by customer needs no shuffle. Days are put in whole: the lines of a day that is there already are replaced, so putting a
day in twice changes nothing; of the table only the months of these days are read and written. A job that fails leaves the
months as they were, since Spark moves the new files in place at the end. Lines without a date have a folder of their own.

The table is one of the session's catalog, so other sessions see it if they share a metastore. Lines are put in by one writer
at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.schema import TRANSACTIONS

BUCKETS = 32


def _placed(tx: DataFrame) -> DataFrame:
    typed = tx.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS])
    return typed.withColumn("month", F.date_format("InvoiceDate", "yyyy-MM"))


def create_store(tx: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Lay ``tx`` out under ``path`` as the table ``name`` and return the table; a table of this name is replaced.

    The rows are dealt by month and bucket, so a task writes few files; a customer that holds a third of all rows is
    spread over the months it buys in.
    """
    spark = tx.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = F.pmod(F.hash("CustomerID"), F.lit(buckets))
    writer = _placed(tx).repartition("month", dealt).write.mode("overwrite").format("parquet").option("path", path)
    writer.partitionBy("month").bucketBy(buckets, "CustomerID").sortBy("CustomerID").saveAsTable(name)
    return read_store(spark, name)


def put_days(tx: DataFrame, name: str) -> None:
    """Put in the lines of ``tx``, which must hold whole days: what the table had of these days is replaced."""
    table, new = tx.sparkSession.table(name), _placed(tx)
    months = [r.month for r in new.select("month").distinct().collect()]  # one row per month
    known, undated = [m for m in months if m is not None], F.col("month").isNull()
    touched = table.where(F.col("month").isin(known) | undated if None in months else F.col("month").isin(known))
    days = new.select(F.to_date("InvoiceDate").alias("_day")).distinct()
    kept = touched.join(days, F.to_date("InvoiceDate").eqNullSafe(F.col("_day")), "left_anti")
    out = kept.unionByName(new).select(*table.columns)
    mode, spark = "spark.sql.sources.partitionOverwriteMode", tx.sparkSession
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # the months in ``out`` and no others; an option of the writer does not reach a table
    try:
        out.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def append_rows(tx: DataFrame, name: str) -> None:
    """Put in lines beside those that are there. Repeating it repeats the lines; ``put_days`` does not."""
    columns = tx.sparkSession.table(name).columns
    _placed(tx).select(*columns).write.insertInto(name)


def read_store(spark: SparkSession, name: str, month: str | None = None) -> DataFrame:
    """The lines, of one month if named, from its folders alone."""
    table = spark.table(name)
    return (table if month is None else table.where(F.col("month") == month)).select(*TRANSACTIONS.fieldNames())
