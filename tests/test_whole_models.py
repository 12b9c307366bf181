"""The registered model queries fit whole models: all six in the whole run, and the default number of trees."""

from conftest import SMALL

from tillroll.catalog import queries
from tillroll.plans import daily, modelling


def test_boosted_models_grow_all_their_trees(spark, monkeypatch):
    made, fit = [], modelling.train_model

    def kept(*args, **settings):
        made.append(fit(*args, **settings))
        return made[-1]

    monkeypatch.setattr(modelling, "train_model", kept)
    assert queries.QUERIES["model_lgbm"](spark, SMALL).count() == 1
    assert len(made[-1].model.stages[-1].ensemble.trees) == modelling.MODELS["LightGBM"].defaults["maxIter"] == 100
    made.clear()
    assert queries.QUERIES["train_all"](spark, SMALL).count() == 6
    trees = {t.name: len(t.model.stages[-1].ensemble.trees) for t in made if t.name in ("XGBoost", "LightGBM")}
    assert trees == {"XGBoost": 100, "LightGBM": 100}


def test_the_whole_run_names_no_models_and_tunes(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(daily, "daily_run", lambda *args, **options: seen.update(args=args, options=options) or {})
    monkeypatch.setattr(queries.files, "union_periods", lambda *counts: None)
    queries.daily_run(spark, SMALL)
    models = seen["args"][4] if len(seen["args"]) > 4 else seen["options"].get("models")
    tune = seen["args"][5] if len(seen["args"]) > 5 else seen["options"].get("tune", True)
    assert models is None and tune
