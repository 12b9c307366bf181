"""The whole run: clean, segment, build features, train, compare, register and score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.plans import cleaning, features, modelling, rfm, scoring
from tillroll.sources.files import load_table, save_table


def daily_run(
    tx: DataFrame,
    folder: str,
    split: str,
    days: int = 90,
    models: list[str] | None = None,
    tune: bool = True,
) -> dict[str, str]:
    """Write every result table under ``folder`` and return their paths by name.

    Each stage reads the table the stage before it wrote. Models and their
    registry lie in ``folder``, too.
    """
    spark = tx.sparkSession
    paths: dict[str, str] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{folder}/{name}"
        save_table(df, paths[name])
        return load_table(spark, paths[name])

    keep("cleaning_report", cleaning.cleaning_report(tx))
    cleaned = keep("cleaned", cleaning.clean_all(tx))
    segments, _ = rfm.rfm_full(cleaned)
    segments = keep("segments", segments)
    keep("segment_summary", rfm.rfm_summary(segments))
    table = keep("features", features.feature_table(cleaned, split, days))
    train, test = modelling.train_test_split(table)
    trained = modelling.train_all(train, tune, names=models)
    comparison = keep("model_comparison", modelling.evaluate(trained, test))
    scores = {row["Model"]: row.asDict() for row in comparison.collect()}  # one row per model
    for each in trained:
        modelling.save_model(each, folder, scores[each.name])
    _, best = modelling.load_best(spark, folder)
    keep("scored", scoring.score_batch(best, table).join(segments.select("CustomerID", "Segment"), "CustomerID", "left"))
    keep("residuals", modelling.residuals(best.transform(test)))
    keep("importance", modelling.permutation_importance(best, test))
    return paths
