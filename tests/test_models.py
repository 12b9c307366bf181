"""Splits, metrics, registry, models and scores."""

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.plans import kpis, modelling, scoring
from tillroll.plans.boosting import HistogramBoosting
from tillroll.plans.features import FEATURES, TARGET


@pytest.fixture(scope="module")
def table(spark):
    """400 customers whose target is 3 x Monetary - 2 x Recency + 7."""
    rng = np.random.default_rng(5)
    values = rng.uniform(0, 100, (400, len(FEATURES))).round(3)
    at = {c: i for i, c in enumerate(FEATURES)}
    rows = [
        (str(i), *map(float, v), float(3 * v[at["Monetary"]] - 2 * v[at["Recency"]] + 7)) for i, v in enumerate(values)
    ]
    schema = "CustomerID string, " + ", ".join(f"{c} double" for c in [*FEATURES, TARGET])
    return spark.createDataFrame(rows, schema).cache()


def test_split_is_stable_and_about_80_20(table):
    train, test = modelling.train_test_split(table)
    assert train.count() + test.count() == 400
    assert 0.7 < train.count() / 400 < 0.9
    shuffled, _ = modelling.train_test_split(table.repartition(7))
    assert shuffled.select("CustomerID").exceptAll(train.select("CustomerID")).count() == 0


def test_settings_are_seeded_and_distinct():
    grid = modelling.MODELS["GradientBoosting"].grid
    first, second = (modelling.sample_settings(grid, 10) for _ in range(2))
    assert first == second
    assert len({str(s) for s in first}) == 10
    assert len(modelling.sample_settings({"a": [1, 2]}, 10)) == 2


def test_metrics_equal_numpy(spark):
    y, p = np.array([0.0, 10.0, 20.0, 40.0]), np.array([1.0, 12.0, 15.0, 50.0])
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], f"{TARGET} double, prediction double")
    got = modelling.metrics(frame).first()
    assert got["MAE"] == pytest.approx(np.abs(y - p).mean())
    assert got["RMSE"] == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert got["R2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["MAPE"] == pytest.approx((np.abs((y - p) / np.where(y > 0, y, 1))[y > 0]).mean() * 100)


def test_mape_without_positive_targets_is_zero(spark):
    frame = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], f"{TARGET} double, prediction double")
    assert modelling.metrics(frame).first()["MAPE"] == 0.0


def test_linear_model_finds_the_rule(spark, table):
    trained = modelling.train_model(table, "LinearRegression")
    assert trained.best_params == {} and trained.cv_rmse == 0.0
    weights = {r["Feature"]: r["Importance"] for r in modelling.feature_importance(spark, trained.model).collect()}
    assert weights["Monetary"] == pytest.approx(3, abs=1e-6)
    assert weights["Recency"] == pytest.approx(-2, abs=1e-6)
    assert modelling.evaluate([trained], table).first()["R2"] == pytest.approx(1)


def test_unknown_model(table):
    with pytest.raises(ValueError, match="unknown model"):
        modelling.train_model(table, "Oracle")


def test_search_returns_the_best_setting(spark, table):
    _, tried, fitted = modelling.random_search(table, "DecisionTree", n_iter=3, folds=3)
    results = modelling.search_results(spark, tried, fitted).collect()
    assert len(results) == 3
    assert results[0]["cv_rmse"] == min(r["cv_rmse"] for r in results)


def test_tuned_tree_beats_the_mean(table):
    train, test = modelling.train_test_split(table)
    trained = modelling.train_model(train, "DecisionTree", n_iter=2)
    assert set(trained.best_params) == {"maxDepth", "minInstancesPerNode"}
    assert modelling.evaluate([trained], test).first()["R2"] > 0.5


@pytest.mark.parametrize("name", ["RandomForest", "GradientBoosting", "XGBoost", "LightGBM"])
def test_ensembles_fit(table, name):
    few = {"numTrees": 5} if name == "RandomForest" else {"maxIter": 5}
    trained = modelling.train_model(table, name, tune=False, **few)
    assert modelling.evaluate([trained], table).first()["R2"] > 0.3
    kinds = {"RandomForest": "RandomForestRegressionModel", "GradientBoosting": "GBTRegressionModel"}
    assert trained.estimator == kinds.get(name, "BoostedModel")


def test_search_of_boosted_trees_grows_all_fits_side_by_side(spark, table, monkeypatch, tmp_path):
    grid = {"maxIter": [3, 6], "stepSize": [0.2], "numLeaves": [4, 15], "subsample": [0.8]}
    monkeypatch.setitem(modelling.MODELS, "LightGBM", modelling.ModelConfig(HistogramBoosting, modelling.MODELS["LightGBM"].defaults, grid))
    trained = modelling.train_model(table, "LightGBM", n_iter=3)
    _, tried, fitted = modelling.random_search(table, "LightGBM", n_iter=3)
    assert len(tried) == 3 and tried[int(np.argmin(fitted.avgMetrics))] == trained.best_params
    assert trained.cv_rmse == pytest.approx(min(fitted.avgMetrics))
    assert fitted.bestModel.getOrDefault("trees") == trained.model.stages[-1].getOrDefault("trees")  # to the last bit
    # one setting and fold by hand
    fold = modelling.hash_bucket(F.col("CustomerID"), 5, "fold")
    errors = []
    for f in range(5):
        alone = modelling.MODELS["LightGBM"].build(**tried[0])
        rows = modelling.assembler().transform(table)
        model = alone.fit_settings(rows.where(fold != f), [({}, -1)], F.col("CustomerID"))[0]
        errors.append(modelling.metrics(model.transform(rows.where(fold == f))).first()["RMSE"])
    assert np.mean(errors) == pytest.approx(fitted.avgMetrics[0], rel=0.05)  # bins of the folds alone differ a little
    modelling.save_model(trained, str(tmp_path), modelling.evaluate([trained], table).first().asDict())
    name, again = modelling.load_best(spark, str(tmp_path))
    same = again.transform(table).join(trained.model.transform(table).select("CustomerID", F.col("prediction").alias("p")), "CustomerID")
    assert name == "LightGBM" and same.where("prediction = p").count() == 400


def test_registry_replaces_names_and_keeps_the_first_of_a_tie(spark, tmp_path):
    folder = str(tmp_path / "registry")
    score = lambda r2: {"MAE": 1, "RMSE": 1, "R2": r2, "MAPE": 1}
    for name, r2 in [("a", 0.9), ("b", 0.5), ("c", 0.5), ("a", 0.1)]:
        modelling.register(spark, folder, name, f"m/{name}", score(r2))
    entries = modelling.read_registry(spark, folder)
    assert {r["name"]: r["R2"] for r in modelling.current_models(entries).collect()} == {"a": 0.1, "b": 0.5, "c": 0.5}
    assert modelling.best_model(entries).first()["name"] == "b"
    assert modelling.read_registry(spark, str(tmp_path / "nowhere")) is None


def test_writers_at_the_same_time_keep_all_entries_and_numbers(spark, tmp_path):
    folder = str(tmp_path / "registry")
    score = {"MAE": 1, "RMSE": 1, "R2": float("nan"), "MAPE": 1}
    with ThreadPoolExecutor(4) as pool:
        work = [pool.submit(modelling.register, spark, folder, f"m{k % 3}", f"p{k}", score) for k in range(24)]
        numbers = sorted(w.result() for w in work)
    assert numbers == list(range(1, 25))
    rows = modelling.read_registry(spark, folder).collect()
    assert sorted(r.seq for r in rows) == numbers and {r.path for r in rows} == {f"p{k}" for k in range(24)}
    assert all(math.isnan(r.R2) for r in rows)
    newest = {r.name: r.seq for r in modelling.current_models(modelling.read_registry(spark, folder)).collect()}
    assert newest == {n: max(r.seq for r in rows if r.name == n) for n in ("m0", "m1", "m2")}


def test_saved_model_predicts_the_same(spark, table, tmp_path):
    trained = modelling.train_model(table, "LinearRegression")
    modelling.save_model(trained, str(tmp_path), modelling.evaluate([trained], table).first().asDict())
    name, model = modelling.load_best(spark, str(tmp_path))
    assert name == "LinearRegression"
    a, b = (scoring.score_batch(m, table).orderBy("CustomerID").toPandas()[scoring.PREDICTED] for m in (trained.model, model))
    assert a.to_numpy() == pytest.approx(b.to_numpy())
    with pytest.raises(FileNotFoundError):
        modelling.load_best(spark, str(tmp_path / "none"))


def test_permutation_importance_ranks_the_used_features(table):
    trained = modelling.train_model(table, "LinearRegression")
    rows = modelling.permutation_importance(trained.model, table).collect()
    assert [r["Feature"] for r in rows][:2] == ["Monetary", "Recency"]
    assert len(rows) == len(FEATURES)
    assert all(abs(r["Importance"]) < 1e-3 for r in rows[2:])


def test_scores_are_clipped_and_whatif_overrides(table):
    model = modelling.train_model(table, "LinearRegression").model
    scored = scoring.score_batch(model, table)
    assert scored.agg(F.min(scoring.PREDICTED)).first()[0] == 0.0
    lifted = scoring.score_whatif(model, table, Monetary=F.col("Monetary") + 10, Recency=0.0)
    rule = F.greatest(F.lit(0.0), F.col("Monetary") * 3 + 7)
    assert lifted.where(F.abs(F.col(scoring.PREDICTED) - rule) > 1e-4).count() == 0
    with pytest.raises(ValueError, match="no such features"):
        scoring.score_whatif(model, table, Colour=1)


def test_tier_borders(spark):
    frame = spark.createDataFrame([("a", 1200.0), ("b", 1200.01), ("c", 200.0), ("d", 199.99)], "CustomerID string, predicted_cltv double")
    got = {r["CustomerID"]: (r["Tier"], r["CAC_Cap"]) for r in scoring.cac_tier_threshold(frame).collect()}
    assert got == {"a": ("Core", 40.0), "b": ("VIP", 150.0), "c": ("Core", 40.0), "d": ("Volume", 10.0)}


def test_percentile_tiers(spark):
    frame = spark.range(100).select(F.format_string("%03d", "id").alias("CustomerID"), F.lit(5.0).alias("predicted_cltv"))
    counts = {r["Tier"]: r["count"] for r in scoring.cac_tier_percentile(frame).groupBy("Tier").count().collect()}
    assert counts == {"VIP": 10, "Core": 40, "Volume": 50}


def test_attribution_of_an_average_customer(spark):
    columns = list(scoring.WEIGHTS)
    rows = [("a", *[1.0] * 5, 10.0), ("b", *[3.0] * 5, 30.0), ("c", *[2.0] * 5, 20.0)]
    frame = spark.createDataFrame(rows, "CustomerID string, " + ", ".join(f"{c} double" for c in columns) + ", predicted_cltv double")
    got = {r["CustomerID"]: r for r in scoring.attribution_local(frame).collect()}
    assert got["c"]["baseline"] == 20.0
    assert all(got["c"][f"{c}_impact"] == 0 for c in columns)
    parts = sum(got["b"][f"{c}_impact"] for c in columns)
    # weights 180 + 70 - 110 + 45 + 55 at one deviation, scaled down to at least a tenth
    assert parts == pytest.approx(240 * 0.1, rel=1e-4)


def test_formulas(spark):
    frame = spark.createDataFrame([("a", 50.0, 4, 100.0)], "CustomerID string, Avg_Order_Value double, Frequency int, Avg_Monthly_Spend double")
    assert scoring.cltv_traditional(frame, 0.5, 0.25).first()["cltv"] == pytest.approx(50 * 4 / 0.5 * 0.25)
    assert scoring.cltv_traditional(frame, 0.0).first()["cltv"] is None
    got = scoring.cltv_discounted(frame, 3, 0.1, 0.6, 0.8).first()["cltv"]
    assert got == pytest.approx(sum(40 * 0.8**t / 1.1**t for t in (1, 2, 3)))


def test_measures_under_any_grouping(lines):
    tx = lines(
        ("1", "A", 2, "2011-01-01", 5, "1", "France"),
        ("1", "B", 1, "2011-01-01", 5, "1", "France"),
        ("2", "B", 1, "2011-01-01", 5, "2", "Spain"),
    ).withColumn("Revenue", F.col("Quantity") * F.col("Price"))
    got = {r["Country"]: r for r in kpis.kpi_by(tx, ["Country"]).collect()}
    assert got["France"]["net_sales"] == 15.0 and got["France"]["total_orders"] == 1
    assert kpis.kpi(tx, "average_order_value").first()[0] == 10.0
    assert kpis.kpi(tx.limit(0), "average_order_value", "purchase_frequency").first() == (0.0, 0.0)
    assert kpis.kpi_by(tx, ["Country", "StockCode"], ["net_sales"]).count() == 3


def test_calendar_covers_whole_years(lines):
    tx = lines(("1", "A", 1, "2011-03-05", 5, "1"), ("2", "A", 1, "2012-02-01", 5, "1"))
    days = kpis.dim_date(tx)
    assert days.count() == 365 + 366
    assert days.agg(F.min("Date").cast("string"), F.max("Date").cast("string")).first() == ("2011-01-01", "2012-12-31")


def test_importance_of_a_model_without_weights_is_zero(spark):
    class Plain:
        pass

    rows = modelling.feature_importance(spark, Plain(), ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [("a", 0.0), ("b", 0.0)]


@pytest.mark.parametrize("name", ["DecisionTree", "RandomForest"])
def test_deep_trees_keep_the_nodes_of_the_rows_and_are_the_same(table, name):
    few = {"numTrees": 3} if name == "RandomForest" else {}
    assert modelling.MODELS[name].build().getCacheNodeIds()
    kept, plain = (
        modelling.train_model(table, name, tune=False, **few, **other).model.stages[-1] for other in ({}, {"cacheNodeIds": False})
    )
    assert kept.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
    assert table.sparkSession.sparkContext.getCheckpointDir() is not None


def test_the_search_of_boosted_trees_fits_what_spark_fits(table):
    """The errors of Spark's boosting come from trees that are Spark's, where both have a bin for every value."""
    coarse = table.select("CustomerID", TARGET, *[F.floor(F.col(c) / 10).cast("double").alias(c) for c in FEATURES])
    ready = modelling.assembler().transform(coarse)
    settings = {"maxIter": 6, "stepSize": 0.2, "maxDepth": 3}
    estimator = modelling.MODELS["GradientBoosting"].build(**settings)
    same, mapped = modelling._as_histograms(modelling.MODELS["GradientBoosting"].build(), [settings])
    model = same.fit_settings(ready, [(mapped[0], -1)], F.col("CustomerID"))[0]
    want, got = (
        [r.prediction for r in m.transform(ready).orderBy("CustomerID").select("prediction").collect()] for m in (estimator.fit(ready), model)
    )
    assert got == pytest.approx(want, rel=1e-6)


def test_all_six_models_are_tuned_unless_named(table, monkeypatch):
    """The whole run searches settings of every model that has any."""
    few = {"DecisionTree": {"maxDepth": [2, 3]}, "RandomForest": {"numTrees": [2, 3]}}
    few |= {name: {"maxIter": [2, 3]} for name in ("GradientBoosting", "XGBoost", "LightGBM")}
    for name, grid in few.items():
        config = modelling.MODELS[name]
        monkeypatch.setitem(modelling.MODELS, name, modelling.ModelConfig(config.estimator, config.defaults, grid))
    trained = modelling.train_all(table)
    assert [t.name for t in trained] == list(modelling.MODELS) and len(trained) == 6
    assert all(t.best_params in [{k: v} for k, vs in few[t.name].items() for v in vs] and t.cv_rmse > 0 for t in trained[1:])
