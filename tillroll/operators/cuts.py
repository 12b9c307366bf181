"""Exact order statistics inside a plan: nothing is written, and no job runs until the result is asked for.

A sample of the rows, chosen by a hash of their key, cuts every ordering into some two thousand buckets of about equal
size; as the cuts are values with their keys, a value that half of all rows share is cut as well. The rows are counted
by bucket, the counts say in which buckets the wanted places lie, and only the rows of these few buckets are put in
order. The rows' own plan is read four times, so it should end in a shuffle, which Spark then runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE = 2048
_STEPS = [1 << k for k in range(13, -1, -1)]


def _bucket(cuts: Column, point: Column) -> Column:
    """How many of the sorted ``cuts`` lie before ``point``, by halving."""
    further = lambda at, step: F.when(F.get(cuts, at + step - 1) < point, at + step).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), further)


def rows_at(df: DataFrame, values: list[str], key: str, places: Column, sample: int = SAMPLE) -> DataFrame:
    """One row: per column of ``values`` an array of (v, key), the rows at ``places`` in the order of value and key.

    ``places`` is an array of positions from 1, told from the number of rows, which is the column ``rows``; those
    outside are left out. ``key`` is unique and not null; the columns of ``values`` have one type and no nulls.
    """
    point = lambda c: F.struct(F.col(c).alias("v"), F.col(key).alias("key"))
    number = df.agg(F.count(F.lit(1)).alias("rows"))
    chosen = df.crossJoin(F.broadcast(number)).where(F.pmod(F.xxhash64(key), F.greatest(F.lit(1), F.floor(F.col("rows") / sample))) == 0)
    cuts = chosen.agg(*[F.sort_array(F.collect_list(point(c))).alias(f"_{c}") for c in values])  # one row, about ``sample`` points each
    points = [F.struct(F.lit(c).alias("name"), point(c).alias("p"), _bucket(F.col(f"_{c}"), point(c)).alias("bucket")) for c in values]
    long = df.crossJoin(F.broadcast(cuts)).select(F.explode(F.array(*points)).alias("x")).select("x.*")
    # from here on: a row per bucket, then one per place, each with a bound of its own
    counts = long.groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("upto", F.sum("n").over(along))
    wanted = number.select(F.explode(places).alias("place"))
    spots = running.crossJoin(F.broadcast(wanted)).where((F.col("upto") - F.col("n") < F.col("place")) & (F.col("place") <= F.col("upto")))
    spots = spots.select("name", "bucket", (F.col("place") - F.col("upto") + F.col("n")).alias("nth"))
    inside = long.join(F.broadcast(spots.select("name", "bucket").distinct()), ["name", "bucket"])
    order = Window.partitionBy("name", "bucket").orderBy("p")
    found = inside.withColumn("nth", F.row_number().over(order)).join(F.broadcast(spots), ["name", "bucket", "nth"])
    return found.agg(*[F.sort_array(F.collect_list(F.when(F.col("name") == c, F.col("p")))).alias(c) for c in values])
