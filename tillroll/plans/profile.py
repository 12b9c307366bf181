"""What a table holds: rows, duplicates, and per column type, distinct values and NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.money import percent


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column, in one pass over the table.

    Grouping sets count every whole row and every column's values at once; hot
    values are combined before the shuffle, and the grouping keys spread it.
    """
    names = df.columns
    counts = df.groupingSets([names] + [[c] for c in names], *names).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n")
    )
    # grouping_id has a 1 bit for every column left out, the first column highest
    all_left_out = (1 << len(names)) - 1
    of_column = {c: all_left_out & ~(1 << (len(names) - 1 - i)) for i, c in enumerate(names)}
    which = F.coalesce(
        F.when(F.col("gid") == 0, F.lit("")), *[F.when(F.col("gid") == g, F.lit(c)) for c, g in of_column.items()]
    )
    is_null = F.coalesce(*[F.when(F.col("gid") == g, F.col(c).isNull()) for c, g in of_column.items()], F.lit(False))
    per_set = (
        counts.withColumn("column_name", which)
        .groupBy("column_name")
        .agg(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("groups"),
            F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("nulls"),
            F.count(F.when(~is_null, 1)).alias("values"),
        )
    )
    # one row per column, and one for whole rows, from here on
    whole, everything = F.col("column_name") == "", Window.partitionBy()
    per_column = per_set.withColumns({
        "total_rows": F.max(F.when(whole, F.col("rows"))).over(everything),
        "duplicate_rows": F.max(F.when(whole, F.col("rows") - F.col("groups"))).over(everything),
    }).where(~whole)
    listed = df.sparkSession.createDataFrame(list(df.dtypes), "column_name string, dtype string")
    zero = F.lit(0).cast("bigint")
    # an empty table has no groups: the left join still lists its columns
    return listed.join(per_column, "column_name", "left").select(
        F.coalesce("total_rows", zero).alias("total_rows"),
        F.lit(len(names)).cast("bigint").alias("total_columns"),
        F.coalesce("duplicate_rows", zero).alias("duplicate_rows"),
        "column_name",
        "dtype",
        F.coalesce("values", zero).alias("unique_values"),
        F.coalesce("nulls", zero).alias("null_count"),
        F.coalesce(percent(F.col("nulls"), F.col("total_rows")), F.lit(0.0)).alias("null_percentage"),
    )
