"""Made-up transaction lines of any size, the same on every partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.schema import TRANSACTIONS

# Products, and the home market against four others.
PRODUCTS = [
    ("85123A", "WHITE HANGING HEART T-LIGHT HOLDER", "2.95"),
    ("71053", "WHITE METAL LANTERN", "3.39"),
    ("84406B", "CREAM CUPID HEARTS COAT HANGER", "2.75"),
    ("84879", "ASSORTED COLOUR BIRD ORNAMENT", "1.69"),
    ("22752", "SET 7 BABUSHKA NESTING BOXES", "7.65"),
]
COUNTRIES = ["Germany", "France", "EIRE", "Spain"]
HOME_SHARE = 85  # of 89
PACKS = [1, 1, 6, 12]
FIRST_INVOICE = 489434
FIRST_DAY = "2009-12-01"
DAYS = 731
BLOCK = 1_000_000


def _draw(salt: str, seed: int, sides: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(sides)).cast("int")


def synthetic_transactions(
    spark: SparkSession, rows: int = 20_000, customers: int = 500, seed: int = 42
) -> DataFrame:
    """5 % cancellations, 20 % guests; a new invoice number starts at one row in five.

    Every value hangs on the row number alone. The invoice number is the count
    of starts so far; it is summed per block of rows and the block sums are
    added up, so no task sees all rows.
    """
    block = F.floor(F.col("id") / BLOCK)
    starts = F.when(_draw("new", seed, 5) == 0, 1).otherwise(0)
    base = spark.range(rows).withColumn("block", block).withColumn("start", starts)
    in_block = Window.partitionBy("block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    blocks_before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per block; the shift is joined back on the block
    shifts = base.groupBy("block").agg(F.sum("start").alias("started")).select(
        "block", F.coalesce(F.sum("started").over(blocks_before), F.lit(0)).alias("shift")
    )
    numbered = base.withColumn("local", F.coalesce(F.sum("start").over(in_block), F.lit(0))).join(shifts, "block")
    invoice = (F.col("shift") + F.col("local") + FIRST_INVOICE).cast("string")
    product = F.element_at(
        F.array(*[F.struct(F.lit(c).alias("c"), F.lit(d).alias("d"), F.lit(p).alias("p")) for c, d, p in PRODUCTS]),
        _draw("product", seed, len(PRODUCTS)) + 1,
    )
    units = (_draw("units", seed, 10) + 1) * F.element_at(
        F.array(*[F.lit(p) for p in PACKS]), _draw("pack", seed, len(PACKS)) + 1
    )
    cancelled = _draw("cancel", seed, 100) < 5
    day = F.to_timestamp_ntz(F.lit(FIRST_DAY)) + F.make_dt_interval(_draw("day", seed, DAYS))
    abroad = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), _draw("abroad", seed, len(COUNTRIES)) + 1)
    made = numbered.select(
        F.when(cancelled, F.concat(F.lit("C"), invoice)).otherwise(invoice).alias("Invoice"),
        product["c"].alias("StockCode"),
        product["d"].alias("Description"),
        F.when(cancelled, -units).otherwise(units).alias("Quantity"),
        day.alias("InvoiceDate"),
        product["p"].alias("Price"),
        F.when(_draw("guest", seed, 100) >= 20, (_draw("customer", seed, customers) + 10_000).cast("string")).alias(
            "CustomerID"
        ),
        F.when(_draw("home", seed, HOME_SHARE + len(COUNTRIES)) < HOME_SHARE, "United Kingdom")
        .otherwise(abroad)
        .alias("Country"),
    )
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS])
