"""Forests in pieces: trees by brute force, one result whatever the sizes of tasks, and nothing that grows with trees on the driver."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillroll.plans import forest, modelling
from tillroll.plans.features import FEATURES, TARGET
from tillroll.plans.forest import Forest, Growth


def brute(x, y, w, rows, depth, least):
    """Mean of every row's leaf, by trying all splits on all features."""
    out = {}
    total, count = (w * y)[rows].sum(), w[rows].sum()
    best = (total * total / count * (1 + 1e-12), None)
    if depth:
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= v]
                s, c = (w * y)[left].sum(), w[left].sum()
                if min(c, count - c) >= least and (by := s * s / c + (total - s) ** 2 / (count - c)) > best[0]:
                    best = (by, (f, v))
    if best[1] is None:
        return {r: total / count for r in rows}
    f, v = best[1]
    for side in (rows[x[rows, f] <= v], rows[x[rows, f] > v]):
        out |= brute(x, y, w, side, depth - 1, least)
    return out


@pytest.mark.parametrize("least, depth, bins", [(1, 30, 5), (3, 30, 40), (1, 3, 40), (1, 30, 200)])
def test_a_tree_equals_brute_force(least, depth, bins):
    """Both ways to add up a node, by all bins and by those with rows."""
    rng = np.random.default_rng(depth + bins)
    x = rng.integers(0, bins, (150, 4)).astype(np.uint8)
    y = np.rint(rng.normal(0, 1e4, 150) + 5e3 * x[:, 0])
    w = rng.poisson(1, 150).astype(float)
    *tree, means, _ = forest.grow(x, y, w, Growth(depth=depth, least=least, columns=4), 200, 1.0, (0, 0))
    rows = np.flatnonzero(w)
    want = brute(x, y, w, rows, depth, least)
    assert np.allclose(means[forest._routed(tuple(tree), x[rows])], [want[r] for r in rows])


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    values = rng.uniform(0, 100, (600, len(FEATURES))).round(2)
    rows = [(str(i), *map(float, v), float(v[0] * 3 + (v[1] > 50) * 100)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "CustomerID string, " + ", ".join(f"{c} double" for c in [*FEATURES, TARGET])).cache()


def fitted(table, **settings):
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[vectors, Forest(featuresCol="features", labelCol=TARGET, **settings)]).fit(table)


def predicted(model, table):
    return [r.prediction for r in model.transform(table).orderBy("CustomerID").select("prediction").collect()]


def test_a_forest_survives_saving_and_does_not_hang_on_the_partitioning(spark, table, tmp_path):
    model = fitted(table, numTrees=7, maxDepth=30, seed=3)
    got = predicted(model, table)
    want = [r[0] for r in table.orderBy("CustomerID").select(TARGET).collect()]
    assert np.corrcoef(got, want)[0, 1] > 0.95
    again = fitted(table.repartition(13), numTrees=7, maxDepth=30, seed=3)
    assert predicted(again, table.repartition(5)) == got  # to the last bit
    path = str(tmp_path / "forest")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert predicted(loaded, table) == got
    assert loaded.stages[-1].featureImportances[0] > 0.3 and sum(loaded.stages[-1].featureImportances) == pytest.approx(1)
    assert loaded.stages[-1].totalNumNodes > 7 * 100


def test_nodes_of_many_rows_are_split_by_jobs_and_the_rest_by_tasks(table, monkeypatch):
    """Without a draw of features, rounds and subtrees make the trees that a task alone makes."""
    settings = {"numTrees": 4, "maxDepth": 8, "featureSubsetStrategy": "all", "seed": 5}
    whole = fitted(table, **settings)
    monkeypatch.setattr(forest, "HELD", 100)
    monkeypatch.setattr(forest, "UNIT_BYTES", 1 << 12)
    cut = fitted(table, **settings)
    assert cut.stages[-1]._about["tops"] and len(cut.stages[-1]._about["pieces"]) > 4
    assert np.allclose(predicted(cut, table), predicted(whole, table), rtol=1e-9)
    assert np.allclose(cut.stages[-1].featureImportances, whole.stages[-1].featureImportances)
    assert cut.stages[-1].totalNumNodes == whole.stages[-1].totalNumNodes
    assert predicted(fitted(table, **settings), table) == predicted(cut, table)


def test_closed_nodes_and_few_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(str(i), float(i % 2), 5.0) for i in range(300)], "CustomerID string, a double, y double")
    ready = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    for held in (forest.HELD, 50):  # the root is pure, and larger than a task's rows
        monkeypatch.setattr(forest, "HELD", held)
        model = Forest(labelCol="y", numTrees=3).fit(ready)
        assert model.transform(ready).where("abs(prediction - 5) < 1e-9").count() == 300
        assert model.totalNumNodes == 3 and list(model.featureImportances) == [0.0]
    with pytest.raises(ValueError, match="no rows"):
        Forest(labelCol="y").fit(ready.where("false"))


def test_the_search_scores_all_settings_side_by_side(table, monkeypatch):
    """The errors of a search are those of single forests on the rows of the other folds."""
    table = table.select("CustomerID", TARGET, *[F.floor(F.col(c) / 10).cast("double").alias(c) for c in FEATURES])  # folds have the same bins
    grid = {"numTrees": [3, 5], "maxDepth": [4, 30], "minInstancesPerNode": [2]}
    monkeypatch.setitem(modelling.MODELS, "RandomForest", modelling.ModelConfig(Forest, modelling.MODELS["RandomForest"].defaults, grid))
    _, tried, found = modelling.random_search(table, "RandomForest", n_iter=4, folds=3)
    assert len(tried) == 4 and len(found.avgMetrics) == 4
    assert found.bestModel.getNumTrees == tried[int(np.argmin(found.avgMetrics))]["numTrees"]
    monkeypatch.setattr(Forest, "settings_errors", lambda *_: None)  # as with too many rows to grow side by side: fold by fold
    _, _, alone = modelling.random_search(table, "RandomForest", n_iter=4, folds=3)
    assert np.allclose(found.avgMetrics, alone.avgMetrics, rtol=1e-6)


def test_a_forest_of_many_nodes_brings_no_node_to_the_driver(spark, table):
    """The model holds a line per piece; Spark's held every node."""
    small, large = (fitted(table, numTrees=n, maxDepth=d).stages[-1] for n, d in ((20, 1), (20, 30)))
    assert large.totalNumNodes > 50 * small.totalNumNodes
    assert len(large.getOrDefault("about")) < 1.2 * len(small.getOrDefault("about"))
