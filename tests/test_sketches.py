"""Sketches against exact numbers, and exact quantiles found by way of a sketch."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quantiles, sketches


@pytest.fixture(scope="module")
def rows(spark):
    """60,000 rows over 30 days: 20,000 customers, one of them with a third of the rows; prices with ties and gaps."""
    who = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 20_000)
    price = F.when(F.col("id") % 4 == 0, 2.5).otherwise((F.col("id") * 104729 % 99_991) / 100).cast("decimal(12,2)")
    return spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), who.alias("customer"), F.when(F.col("id") % 10 > 0, price).alias("price"), (F.col("id") % 17).alias("units")
    )


def test_united_sketches_count_like_one_of_the_whole(rows):
    daily = sketches.distinct_sketches(rows, ["day"], ["customer", "price"])
    assert daily.count() == 30
    united = sketches.distinct_estimates(daily, [], ["customer", "price"]).first()
    whole = sketches.distinct_estimates(sketches.distinct_sketches(rows, [], ["customer", "price"]), [], ["customer", "price"]).first()
    exact = rows.agg(F.countDistinct("customer").alias("customer"), F.countDistinct("price").alias("price")).first()
    halves = [sketches.distinct_estimates(daily.where(f"day {side} 15"), [], ["customer"]).first()[0] for side in ("<", ">=")]
    for c in ("customer", "price"):
        assert abs(united[c] - whole[c]) <= 0.01 * exact[c]
        assert abs(united[c] - exact[c]) <= 0.05 * exact[c]  # three standard errors
    assert max(halves) <= united.customer * 1.05


def test_only_sketches_are_shuffled(rows):
    plan = sketches.distinct_sketches(rows, ["day"], ["customer"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_hll_sketch_agg" in plan


def test_quantiles_from_daily_sketches(rows):
    asked = [0.01, 0.25, 0.5, 0.9, 0.99]
    daily = sketches.quantile_sketches(rows, ["day"], ["price"])
    found = sketches.quantile_estimates(daily, [], ["price"], asked).first().price
    n = rows.where("price IS NOT NULL").count()
    for q, value in zip(asked, found):
        low, high = rows.agg(F.count_if(F.col("price").cast("double") < value), F.count_if(F.col("price").cast("double") <= value)).first()
        assert low / n - 0.03 <= q <= high / n + 0.03  # the rank is off by less than the error of a sketch of 200


@pytest.mark.parametrize("margin", [0.01, 0.2, 1e-9])
def test_bracketed_quantiles_are_exact(rows, margin):
    """Ties, NULLs, the ends, and brackets so narrow that they miss."""
    asked = [0.0, 0.01, 0.25, 0.333, 0.5, 0.99, 1.0]
    key = lambda r: (r.name, r.q)
    want = sorted(quantiles.exact_quantiles(rows, ["price", "units"], asked).collect(), key=key)
    got = sorted(sketches.bracketed_quantiles(rows, ["price", "units"], asked, margin=margin).collect(), key=key)
    assert [(r.name, r.q, r.value) for r in got] == [(r.name, r.q, r.value) for r in want]


def test_no_rows(rows):
    none = rows.where("false")
    assert sketches.bracketed_quantiles(none, ["price"], [0.5]).collect() == quantiles.exact_quantiles(none, ["price"], [0.5]).collect() == []
    assert sketches.distinct_estimates(sketches.distinct_sketches(none, ["day"], ["customer"]), ["day"], ["customer"]).collect() == []
