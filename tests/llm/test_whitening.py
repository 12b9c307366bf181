"""Whitening against numpy on whole numbers and on odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillroll.llm import whitening
from tillroll.llm.queries import LLM_QUERIES

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, scale=256.0):
    """By row: the exact deviation; then the covariance of the distinct vectors, by sums of products of fractions."""
    width = max(len(v) for _, v in rows)
    x = [[math.floor(scale * c) for c in v] + [0] * (width - len(v)) for _, v in rows]
    fit = [list(v) for v in sorted(set(map(tuple, x)))]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(width)] for i in range(width)]
    return x, n, sums, np.array(cov)


def compare(spark, rows, components=4):
    out = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND), components=components).collect()
    x, n, sums, cov = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    assert len(out) == len(rows) * min(components, len(sums))
    by_row = {}
    for r in out:
        by_row.setdefault((r.vec_id, r.component), []).append(r)
    for (i, _), v in zip(rows, x):
        for c, at in enumerate(order, 1):
            r = by_row[i, c].pop()
            assert r.n == n and int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(v, sums))
            assert math.isclose(r.explained, values[at] / np.trace(cov), rel_tol=1e-9)
            want = float((np.array(v, float) - np.array(sums) / n) @ vectors[:, at] / np.sqrt(values[at]))
            assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-7, abs_tol=1e-7)
            assert r.identity_error < 1e-8


def test_covariance_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=5) * [3, 1, 2, 0.5, 9] + 100).tolist()) for i in range(60)]
    rows.append((60, rows[0][1]))  # a copy does not count in the fit
    frame, width = whitening._prepared(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND), "vec_id", "embedding", 256.0)
    n, sums, cov = whitening.covariance(frame.select("x").distinct(), width)
    _, want_n, want_sums, want = brute(rows)
    assert (n, sums) == (want_n, want_sums) and n == 60
    assert np.array_equal(cov, want)  # to the last bit, as both divide whole numbers once
    compare(spark, rows)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(rng.integers(-(2**50), 2**50)), float(rng.integers(-9, 9)), 2.0**62 / 256 * (i % 2)]) for i in range(20)]
    frame, width = whitening._prepared(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND), "vec_id", "embedding", 256.0)
    _, _, cov = whitening.covariance(frame.select("x").distinct(), width)
    assert np.array_equal(cov, brute(rows)[3])
    far = whitening.whitened(spark.createDataFrame([(1, [1e300], 0), (2, [-1e300], 0)], KIND)).collect()
    assert len(far) == 2 and {abs(r.whitened) for r in far} == {1.0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0]), (3, [-0.001, 0.5]), (4, [0.25, -3.0])]
    compare(spark, rows, components=2)
    left_out = [(5, None, 0), (6, [1.0, None], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows] + left_out, KIND)
    odd = frame.withColumn("n", F.lit("x")).withColumn("id", F.lit("y")).withColumn("whitened", F.lit(None).cast("string"))
    assert sorted(whitening.whitened(odd).collect(), key=str) == sorted(whitening.whitened(frame).collect(), key=str)
    assert {r.vec_id for r in whitening.whitened(frame).collect()} == {1, None, 3, 4}
    for none in (frame.where("false"), frame.where("vec_id > 4"), spark.createDataFrame([(1, [], 0)], KIND)):
        assert whitening.whitened(none).collect() == []
    same = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], KIND)).collect()
    assert len(same) == 4 and all(r.whitened == 0 and r.deviation == 0 and r.n == 1 and r.identity_error == 1 for r in same)


def test_partitions_do_not_matter(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(100)
    one, many = (whitening.whitened(vectors.repartition(k)).select("vec_id", "component", "deviation", "n").collect() for k in (1, 7))
    assert sorted(one) == sorted(many)


@pytest.mark.parametrize("columns", [["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]])
def test_query(spark, columns):
    out = LLM_QUERIES["op12_whitening"](spark, SMALL)
    assert out.columns == columns
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    x, n, sums, cov = brute(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    got = out.collect()
    assert len(got) == 4 * len(rows)
    place = {i: k for k, (i, _) in enumerate(rows)}
    for r in got:
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[place[r.vec_id]], sums))
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-8
