"""Cleaning steps and their audit on hand-made lines."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.plans import cleaning
from tillroll.plans.profile import table_profile


@pytest.fixture(scope="module")
def dirty(lines):
    return lines(
        ("1", "A", 2, "2011-01-01", 5, None),  # guest
        (" C2", "A", -2, "2011-01-01", 5, "13085.0"),  # cancelled, untrimmed
        ("3", "A", 0, "2011-01-01", 5, "13085"),  # no quantity
        ("4", "A", 1, "2011-01-01", 0, "13085"),  # no price
        ("5", "A", 3, "2011-01-01", 5, "13085.0"),  # kept
        ("5", "A", 3, "2011-01-01", 5, "13085"),  # duplicate once typed
        ("5", "A", 3, "2011-01-01", 5, "13085", "United Kingdom", "thing"),  # differs in case: kept
        ("6", "post", 1, "2011-01-01", 5, "13085"),  # service
        ("7", "A", 1, "2011-01-01", 5, "AMAZONFBA"),  # test account
        ("8", "B", 4, "2011-01-01", 2.5, " 77 "),  # kept, trimmed
        ("9", "B", None, "2011-01-01", 2.5, "77"),  # no quantity at all
    )


def test_steps_keep_the_right_lines(dirty):
    kept = cleaning.clean_lines(dirty).collect()
    assert sorted((r["Invoice"], r["CustomerID"], r["Description"]) for r in kept) == [
        ("5", "13085", "THING"), ("5", "13085", "thing"), ("8", "77", "THING"),
    ]


def test_report_chains_and_agrees_with_the_steps(dirty):
    report = {r["step_name"]: r for r in cleaning.cleaning_report(dirty).collect()}
    rows = [report[name] for name in cleaning.AUDITED]
    assert rows[0]["rows_before"] == dirty.count()
    assert rows[-1]["rows_after"] == cleaning.clean_lines(dirty).count()
    for earlier, later in zip(rows, rows[1:]):
        assert earlier["rows_after"] == later["rows_before"]
    assert [r["rows_removed"] for r in rows] == [1, 1, 2, 1, 1, 2]
    assert rows[0]["pct_removed"] == 9.0909
    assert rows[-1]["total_removed"] == 8
    assert rows[-1]["total_removed_pct"] == 72.73


def test_report_of_an_empty_table(lines, dirty):
    rows = cleaning.cleaning_report(dirty.limit(0)).collect()
    assert len(rows) == 6
    assert all(r["rows_before"] == 0 and r["pct_removed"] == 0.0 for r in rows)


def test_winsorize_equals_numpy(spark, lines):
    rng = np.random.default_rng(3)
    quantity = rng.integers(1, 400, 333)
    price = rng.integers(1, 9000, 333)
    tx = lines(*[(str(i), "A", int(q), "2011-01-01", Decimal(int(p)) / 100, "1") for i, (q, p) in enumerate(zip(quantity, price))])
    got = cleaning.add_revenue(cleaning.winsorize(tx)).toPandas()
    got = got.assign(at=got["Invoice"].astype(int)).sort_values("at")
    for column, values in (("Quantity", quantity.astype(float)), ("Price", price / 100)):
        expected = np.clip(values, np.quantile(values, 0.01), np.quantile(values, 0.99))
        assert got[column].astype(float).to_numpy() == pytest.approx(expected, abs=1e-9)
    revenue = got["Quantity"].astype(float) * got["Price"].astype(float)
    assert got["Revenue"].astype(float).to_numpy() == pytest.approx(revenue.to_numpy(), abs=1e-6)


def test_description_is_trimmed_and_null_stays_null(spark, lines):
    tx = lines(("1", "A", 1, "2011-01-01", 1, "1", "EIRE", "  red Lamp "), ("2", "A", 1, "2011-01-01", 1, "1", "EIRE", None))
    assert {r["Description"] for r in cleaning.clean_description(tx).collect()} == {"RED LAMP", None}


def test_clean_all_adds_revenue(dirty):
    out = cleaning.clean_all(dirty)
    assert out.count() == 3
    assert out.where(F.col("Revenue") <= 0).count() == 0


def test_profile_counts_nulls_and_duplicates(dirty):
    rows = {r["column_name"]: r for r in table_profile(dirty.unionByName(dirty.limit(2))).collect()}
    assert len(rows) == 8
    assert rows["Invoice"]["total_rows"] == 13
    assert rows["Invoice"]["total_columns"] == 8
    assert rows["Invoice"]["duplicate_rows"] == 2
    assert rows["CustomerID"]["null_count"] >= 1
    assert rows["Price"]["dtype"] == "decimal(12,2)"
    assert rows["Country"]["unique_values"] == 1


def test_profile_of_an_empty_table(dirty):
    rows = table_profile(dirty.limit(0)).collect()
    assert len(rows) == 8
    assert all(r["total_rows"] == 0 and r["null_percentage"] == 0.0 for r in rows)
