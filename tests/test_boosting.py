"""Histogram boosting against trees grown by brute force."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillroll.plans import boosting
from tillroll.plans.boosting import Growth, HistogramBoosting


def frame(spark, x, y, parts=3):
    rows = [(i, [float(v) for v in xs], float(t)) for i, (xs, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x array<double>, y double").repartition(parts)


def gain(g, n, lam):
    return g * g / (n + lam) if n + lam else 0.0


def splits_of(x, g, rows, s):
    """All allowed splits of a node as (gain, feature, value), by sorting nothing and trying every value."""
    out = []
    for f in range(x.shape[1]):
        for v in np.unique(x[rows, f])[:-1]:
            left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
            if min(len(left), len(right)) >= max(s.child_rows, s.child_weight):
                by = gain(g[left].sum(), len(left), s.lam) + gain(g[right].sum(), len(right), s.lam) - gain(g[rows].sum(), len(rows), s.lam)
                out.append((by / 2 - s.gamma, f, v))
    return [c for c in out if c[0] > 1e-9]


def brute(x, y, s):
    """Predictions of boosted trees that split the leaf of largest gain one at a time, or all leaves of a level."""
    score, shapes = np.full(len(y), y.mean()), []
    for _ in range(s.rounds):
        g = score - y
        leaves, splits = [(np.arange(len(y)), 0)], 0
        while True:
            best = []
            for k, (rows, depth) in enumerate(leaves):
                found = splits_of(x, g, rows, s) if not s.depth or depth < s.depth else []
                if found:
                    best.append((max(found, key=lambda c: (round(c[0], 9), -c[1], -c[2])), k))
            if not best or (s.leaves and splits >= s.leaves - 1):
                break
            (_, f, v), k = max(best, key=lambda b: b[0][0])
            rows, depth = leaves.pop(k)
            leaves += [(rows[x[rows, f] <= v], depth + 1), (rows[x[rows, f] > v], depth + 1)]
            splits += 1
        for rows, _ in leaves:
            score[rows] += -s.rate * g[rows].sum() / (len(rows) + s.lam)
        shapes.append(len(leaves))
    return score, shapes


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 60, (200, 5)).astype(float)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 30, 50, 0) * (x[:, 2] > 10) + rng.normal(0, 5, 200)
    return x, y


CASES = [
    Growth(rounds=3, leaves=15, child_rows=5),
    Growth(rounds=3, leaves=8, child_rows=1, lam=2.0, depth=3),
    Growth(rounds=3, leaves=0, depth=3, child_rows=1, lam=1.0, rate=0.3),
    Growth(rounds=2, leaves=0, depth=4, child_rows=1, gamma=150.0, child_weight=7.0),
    Growth(rounds=12, leaves=4, child_rows=20, rate=0.5),
]


@pytest.fixture(scope="module")
def models(spark, data):
    return boosting.fit_many(frame(spark, *data), [(s, -1) for s in CASES], "x", "y", F.col("id"))


@pytest.mark.parametrize("k", range(len(CASES)))
def test_trees_equal_brute_force(data, models, k):
    want, shapes = brute(*data, CASES[k])
    assert np.allclose(models[k].predict(data[0]), want, rtol=1e-9, atol=1e-6)
    got = [sum(c == 0 for c in t.children) for t in models[k].trees]
    assert got == shapes and len(got) == CASES[k].rounds
    if CASES[k].leaves:
        assert max(got) <= CASES[k].leaves
    if CASES[k].depth:
        assert max(max(t.depth) for t in models[k].trees) <= CASES[k].depth


def test_gains_equal_a_hand_computation():
    """Gradients -4, -2, 6 in three bins of 2, 1 and 3 rows, lambda 1: 16/3 + 16/5 - 0, and 36/4 + 36/4 - 0, halved, less gamma."""
    g = Growth(lam=1.0, gamma=0.5, child_rows=1)
    found = boosting.best_split(np.array([[-4.0, -2.0, 6.0]]), np.array([[2, 1, 3]]), g, [7])
    assert (found.gain, found.feature, found.bin) == (pytest.approx((36 / 4 + 36 / 4) / 2 - 0.5), 7, 1)
    narrow = boosting.best_split(np.array([[-4.0, -2.0, 6.0]]), np.array([[2, 1, 3]]), Growth(lam=1.0, child_weight=4.0), [7])
    assert narrow is None


def test_fits_side_by_side_equal_fits_alone(spark, data):
    rows = frame(spark, *data)
    fold = F.pmod(F.col("id"), F.lit(4)).cast("int")
    s = Growth(rounds=11, leaves=6, row_share=0.7, column_share=0.6)
    together = boosting.fit_many(rows, [(s, 1), (CASES[0], 2), (s, -1)], "x", "y", F.col("id"), fold)
    alone = boosting.fit_many(rows.repartition(7), [(s, 1)], "x", "y", F.col("id"), fold)[0]
    assert together[0].to_json() == alone.to_json()  # to the last bit, whatever the partitions
    held_out = boosting.fit_many(rows.where("id % 4 <> 2"), [(CASES[0], -1)], "x", "y", F.col("id"))[0]
    assert np.allclose(held_out.base, together[1].base)
    used = [{f for f, c in zip(t.feature, t.children) if c} for t in together[2].trees]
    assert all(len(u) <= 3 for u in used) and len(set().union(*used)) > 3  # three of five features a tree


def test_jobs_follow_the_depth_not_the_leaves(spark, data):
    jobs = spark._jsc.sc().dagScheduler()

    def started(leaves):
        before = jobs.nextJobId()
        boosting.fit_many(frame(spark, *data), [(Growth(rounds=1, leaves=leaves, child_rows=1), -1)] * 3, "x", "y", F.col("id"))
        return jobs.nextJobId() - before

    started(2)
    assert started(31) - started(4) < 27  # one job per split and fit would be 81 more


def test_learns_a_step_rule_and_survives_saving(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 100, (400, 3)).round(2)
    y = np.where(x[:, 0] > 40, 100.0, 0.0) + np.where(x[:, 1] > 70, 30.0, 0.0)
    rows = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, c double, label double")
    for kind in ({"numLeaves": 31}, {"numLeaves": 0, "maxDepth": 6, "regLambda": 1.0, "minChildRows": 1}):
        boosted = HistogramBoosting(maxIter=20, stepSize=0.5, **kind)
        model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), boosted]).fit(rows)
        got = np.array([r.prediction for r in model.transform(rows).orderBy("a", "b", "c").collect()])
        want = np.array([r.label for r in rows.orderBy("a", "b", "c").collect()])
        assert np.abs(got - want).max() < 1 < np.abs(want - want.mean()).mean()
        path = str(tmp_path / str(len(kind)))
        model.write().overwrite().save(path)
        again = np.array([r.prediction for r in PipelineModel.load(path).transform(rows).orderBy("a", "b", "c").collect()])
        assert np.array_equal(got, again)
        shares = model.stages[-1].featureImportances
        assert shares[0] > shares[1] > 0.02 > shares[2]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, None], 5.0), (2, [None, None], 7.0), (3, [2.0, None], None)], "id long, x array<double>, y double")
    model = boosting.fit_many(rows, [(Growth(rounds=40, child_rows=1, rate=0.5), -1)], "x", "y", F.col("id"))[0]
    assert np.allclose(model.predict(np.array([[1.0, np.nan], [np.nan, np.nan]])), [5, 7])
    with pytest.raises(ValueError):
        boosting.fit_many(rows.where("false"), [(Growth(), -1)], "x", "y", F.col("id"))
    same = spark.createDataFrame([(i, [1.0], 4.0) for i in range(50)], "id long, x array<double>, y double")
    flat = boosting.fit_many(same, [(Growth(rounds=2), -1)], "x", "y", F.col("id"))[0]
    assert [len(t.feature) for t in flat.trees] == [1, 1] and np.allclose(flat.predict(np.array([[1.0], [9.0]])), 4)


def test_a_task_grows_what_rounds_of_jobs_grow(spark, data, monkeypatch):
    """Rows that fit in a task cost a few jobs whatever the trees, and the trees are the same to the last bit."""
    rows, fold = frame(spark, *data), F.pmod(F.col("id"), F.lit(4)).cast("int")
    fits = [(Growth(rounds=11, leaves=6, row_share=0.7, column_share=0.6), 1), *[(replace(s, rounds=2), k - 1) for k, s in enumerate(CASES)]]
    jobs = spark._jsc.sc().dagScheduler()
    before = jobs.nextJobId()
    alone = boosting.fit_many(rows, fits, "x", "y", F.col("id"), fold)
    started = jobs.nextJobId() - before
    before = jobs.nextJobId()
    boosting.fit_many(rows, [(replace(s, rounds=10 * s.rounds), f) for s, f in fits], "x", "y", F.col("id"), fold)
    assert jobs.nextJobId() - before == started < 20
    monkeypatch.setattr(boosting, "HELD", 0)
    rounds = boosting.fit_many(rows, fits, "x", "y", F.col("id"), fold)
    assert [m.to_json() for m in alone] == [m.to_json() for m in rounds]
    assert [[t.depth for t in m.trees] for m in alone] == [[t.depth for t in m.trees] for m in rounds]


def test_rounds_of_jobs_equal_brute_force(spark, data, monkeypatch):
    """As for rows that do not fit in a task."""
    monkeypatch.setattr(boosting, "HELD", 0)
    models = boosting.fit_many(frame(spark, *data), [(s, -1) for s in CASES[:3]], "x", "y", F.col("id"))
    for s, model in zip(CASES, models):
        assert np.allclose(model.predict(data[0]), brute(*data, s)[0], rtol=1e-9, atol=1e-6)


def test_errors_of_a_search_come_from_tasks_without_trees(spark, data, monkeypatch):
    rows, fold = frame(spark, *data), F.pmod(F.col("id"), F.lit(4)).cast("int")
    fits = [(replace(s, rounds=3), f) for s in CASES[:3] for f in (0, 3, 9)]
    monkeypatch.setattr(boosting, "_grow_alone", None)  # which brings trees to the driver
    errors = boosting.held_out_errors(rows, fits, "x", "y", F.col("id"), fold)
    monkeypatch.undo()
    models = boosting.fit_many(rows, fits, "x", "y", F.col("id"), fold)
    for error, model, (_, f) in zip(errors, models, fits):
        out = np.arange(200) % 4 == f
        assert error is None if f == 9 else np.isclose(error, np.sqrt(np.mean((model.predict(data[0][out]) - data[1][out]) ** 2)))
    monkeypatch.setattr(boosting, "HELD", 0)
    assert boosting.held_out_errors(rows, fits, "x", "y", F.col("id"), fold) is None
