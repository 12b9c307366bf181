"""Global orders, quantiles and NOT IN against pandas and plain Spark."""

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window, functions as F

from tillroll.functions.rules import ntile_of_rank, qcut_of_rank
from tillroll.operators import cuts
from tillroll.operators.joins import not_in
from tillroll.operators.ordering import (
    global_lag,
    global_rank,
    global_row_number,
    global_running_total,
    with_totals,
)
from tillroll.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def tied(spark):
    """4,000 rows; a third share one value."""
    value = F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") * 37 % 101)
    return spark.range(4000).select(F.format_string("k%05d", "id").alias("key"), value.cast("bigint").alias("value"))


def test_row_number_equals_the_window(spark, tied):
    ours = global_row_number(tied, [F.desc("value"), F.asc("key")], "rn", "n")
    assert ours.rdd.getNumPartitions() > 1
    plain = tied.withColumn("expected", F.row_number().over(Window.orderBy(F.desc("value"), "key")))
    both = ours.join(plain, "key")
    assert both.count() == 4000
    assert both.where("rn <> expected OR n <> 4000").count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_the_window(tied, descending):
    ours = global_rank(tied, "value", "key", "r", descending)
    order = F.desc("value") if descending else F.asc("value")
    plain = tied.withColumn("expected", F.rank().over(Window.orderBy(order)))
    both = ours.join(plain, "key")
    assert both.count() == 4000
    assert both.where("r <> expected").count() == 0


def test_rank_of_one_value_spanning_all_partitions(spark):
    same = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("value"))
    assert global_rank(same, "value", "key", "r").where("r <> 1").count() == 0


def test_rank_with_nulls(spark):
    rows = [("a", None), ("b", 3), ("c", None), ("d", 3), ("e", 1)]
    ours = global_rank(spark.createDataFrame(rows, "key string, value int"), "value", "key", "r")
    assert {r["key"]: r["r"] for r in ours.collect()} == {"b": 1, "d": 1, "e": 3, "a": 4, "c": 4}


def test_running_total(tied):
    ours = global_running_total(tied, [F.asc("key")], "value", "upto")
    frame = ours.toPandas().sort_values("key")
    assert (frame["upto"] == frame["value"].cumsum()).all()


def test_lag_of_a_group_spanning_partitions(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") * 7919 % 3001).alias("v"),
        F.col("id"),
    )
    ours = global_lag(rows, "g", ["v", "id"], "v", "before")
    expected = F.lag("v").over(Window.partitionBy("g").orderBy("v", "id"))
    plain = rows.withColumn("expected", expected).drop("g", "v")
    both = ours.join(plain, "id")
    assert both.count() == 3000
    assert both.where("NOT before <=> expected").count() == 0


def test_lag_of_null_groups(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    ours = {r["v"]: r["before"] for r in global_lag(rows, "g", ["v"], "v", "before").collect()}
    assert ours == {1: None, 2: 1, 3: None}


def test_with_totals(tied):
    out = with_totals(tied, tied, top=F.max("value"), n=F.count(F.lit(1)))
    assert out.where("top = 100 AND n = 4000").count() == 4000


def test_empty_input(spark):
    empty = spark.createDataFrame([], "key string, value bigint")
    assert global_row_number(empty, [F.asc("key")], "rn", "n").count() == 0
    assert global_rank(empty, "value", "key", "r").count() == 0
    assert exact_quantiles(empty, ["value"], [0.5]).count() == 0


def test_ntile_equals_spark_for_all_small_sizes(spark):
    rows = spark.range(3, 60).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(1), F.col("id"))).alias("rn"))
    for buckets in (4, 5, 7):
        window = F.ntile(buckets).over(Window.partitionBy("n").orderBy("rn"))
        wrong = rows.withColumn("expected", window).where(ntile_of_rank(F.col("rn"), F.col("n"), buckets) != F.col("expected"))
        assert wrong.count() == 0


def test_qcut_equals_pandas(spark):
    sizes = [*range(5, 80), 495, 1498, 4300]
    frames = []
    for n in sizes:
        rank = pd.Series(np.arange(1, n + 1, dtype=float))
        bins = pd.qcut(rank, 5, labels=range(1, 6)).astype(int)
        frames.append(pd.DataFrame({"n": n, "rn": np.arange(1, n + 1), "expected": bins}))
    rows = spark.createDataFrame(pd.concat(frames))
    assert rows.where(qcut_of_rank(F.col("rn"), F.col("n"), 5) != F.col("expected")).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-500, 500), min_size=1, max_size=60), st.sampled_from([0.01, 0.25, 0.5, 0.9, 0.99]))
def test_quantiles_equal_pandas(spark, values, q):
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    found = exact_quantiles(frame, ["v"], [q]).first()["value"]
    assert float(found) == pytest.approx(pd.Series(values).quantile(q), abs=1e-4)


def test_quantiles_of_several_columns_skip_nulls(spark):
    frame = spark.createDataFrame([(1, 10), (2, None), (3, 30), (None, 20)], "a int, b int")
    found = {(r["name"], r["q"]): float(r["value"]) for r in exact_quantiles(frame, ["a", "b"], [0.0, 0.5, 1.0]).collect()}
    assert found == {
        ("a", 0.0): 1, ("a", 0.5): 2, ("a", 1.0): 3, ("b", 0.0): 10, ("b", 0.5): 20, ("b", 1.0): 30,
    }


@pytest.mark.parametrize("listed", [["a"], ["a", None], [], [None]])
def test_not_in_follows_sql(spark, listed):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([(v,) for v in listed], "k string")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    expected = {r["k"] for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)").collect()}
    assert {r["k"] for r in not_in(left, right, "k").collect()} == expected


def test_row_part_of_increasing_ids(spark):
    """The global orders rest on this: the lower 33 bits count the rows of a partition from 0."""
    rows = spark.range(1000).repartition(7).select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("r")
    )
    per_part = rows.groupBy("p").agg(F.min("r").alias("a"), F.max("r").alias("b"), F.countDistinct("r").alias("n"))
    assert all(r.a == 0 and r.b == r.n - 1 for r in per_part.collect())


@pytest.mark.parametrize("sample", [4, 64, 5000])
def test_rows_at_places(spark, sample):
    """Ties, a value that most rows share, and every place, with buckets of many and of single rows."""
    rng = random.Random(sample)
    rows = [(f"c{i:04d}", Decimal(rng.choice([0, 0, 0, 0, 7, rng.randrange(90)])), Decimal(-i)) for i in range(700)]
    df = spark.createDataFrame(rows, "id string, a decimal(38,10), b decimal(38,10)").repartition(5)
    got = cuts.rows_at(df, ["a", "b"], "id", F.sequence(F.lit(1), F.col("rows").cast("int"), F.lit(23)), sample).first()
    for column, at in (("a", 1), ("b", 2)):
        order = sorted((r[at], r[0]) for r in rows)
        assert [(p.v, p.key) for p in got[column]] == order[::23]
    outside = cuts.rows_at(df, ["a"], "id", F.array(F.lit(0), F.lit(700), F.lit(701))).first()
    assert [(p.v, p.key) for p in outside.a] == [max((r[1], r[0]) for r in rows)]
    assert cuts.rows_at(df.where("false"), ["a", "b"], "id", F.array(F.lit(1))).first() == ([], [])
