"""Joins Spark plans unsafely at scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.staging import written


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (right)`` with SQL's NULL rule, without broadcasting the list.

    One NULL in the list empties the result; a NULL key passes only an empty
    list. The list is reduced to its distinct values once; the two facts about
    it are a single row.
    """
    listed = written(right.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "listed")
    facts = listed.agg(
        F.count(F.lit(1)).alias("_listed"), F.count(F.when(F.col(key).isNull(), 1)).alias("_nulls")
    )
    kept = left.join(listed.where(F.col(key).isNotNull()), key, "left_anti")
    passes = (F.col("_listed") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())
    return kept.crossJoin(F.broadcast(facts)).where(passes).drop("_listed", "_nulls")
