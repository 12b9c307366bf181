"""Regression models for the spend after the split, with Spark ML.

The gradient-boosting libraries some shops use are not part of Spark. Their
places are taken by ``boosting``: binned features, second-order gains, trees
grown by levels or by best leaf. Spark's forest is on the driver as a whole;
``forest`` takes its place. Every result names the estimator that produced it.
"""

from __future__ import annotations

import itertools
import json
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.functions.money import ratio
from tillroll.operators.ordering import global_row_number
from tillroll.plans.boosting import HistogramBoosting
from tillroll.plans.features import FEATURES, TARGET
from tillroll.plans.forest import Forest
from tillroll.session import shared_dir
from tillroll.staging import written

SEED = 42


@dataclass(frozen=True)
class ModelConfig:
    """An estimator with its untuned settings, and the settings the search draws from."""

    estimator: type[Estimator]
    defaults: dict[str, Any] = field(default_factory=dict)
    grid: dict[str, list] = field(default_factory=dict)

    def build(self, **settings: Any) -> Estimator:
        return self.estimator(featuresCol="features", labelCol=TARGET, **{**self.defaults, **settings})


# The six models and their search spaces. Spark trees have no
# minimum size to split a node and stop at depth 30, which stands for no limit.
# Deep trees keep the node of every row beside the rows, so that a job need not
# carry the trees grown so far; the trees are the same.
MODELS = {
    "LinearRegression": ModelConfig(LinearRegression),
    "DecisionTree": ModelConfig(
        DecisionTreeRegressor,
        {"seed": SEED, "maxDepth": 30, "cacheNodeIds": True},
        {"maxDepth": [3, 5, 7, 10, 15], "minInstancesPerNode": [1, 2, 4, 8]},
    ),
    "RandomForest": ModelConfig(
        Forest,
        {"seed": SEED, "numTrees": 100, "maxDepth": 30, "cacheNodeIds": True},
        {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15, 30], "minInstancesPerNode": [1, 2, 4]},
    ),
    "GradientBoosting": ModelConfig(
        GBTRegressor,
        {"seed": SEED, "maxIter": 100, "stepSize": 0.1, "maxDepth": 3},
        {
            "maxIter": [50, 100, 200],
            "stepSize": [0.01, 0.05, 0.1, 0.2],
            "maxDepth": [3, 4, 5, 6],
            "subsamplingRate": [0.8, 0.9, 1.0],
        },
    ),
    "XGBoost": ModelConfig(
        HistogramBoosting,
        {
            "seed": SEED, "maxIter": 100, "stepSize": 0.3, "numLeaves": 0, "maxDepth": 6, "regLambda": 1.0, "minChildWeight": 1.0,
            "minChildRows": 1,
        },
        {
            "maxIter": [50, 100, 200],
            "stepSize": [0.01, 0.05, 0.1, 0.2],
            "maxDepth": [3, 5, 7],
            "subsample": [0.8, 1.0],
            "columnShare": [0.8, 1.0],
        },
    ),
    "LightGBM": ModelConfig(
        HistogramBoosting,
        {"seed": SEED, "maxIter": 100, "stepSize": 0.1, "numLeaves": 31, "minChildRows": 20},
        {
            "maxIter": [50, 100, 200],
            "stepSize": [0.01, 0.05, 0.1, 0.2],
            "numLeaves": [15, 31, 63],
            "subsample": [0.8, 1.0],
        },
    ),
}


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """A number below ``buckets`` that hangs on the key alone, not on row order or partitioning."""
    digest = F.md5(F.concat(key, F.lit(salt)) if salt else key)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def with_split(features: DataFrame, train_pct: int = 80) -> DataFrame:
    side = F.when(hash_bucket(F.col("CustomerID"), 100) < train_pct, "train").otherwise("test")
    return features.withColumn("split", side)


def train_test_split(features: DataFrame, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    marked = with_split(features, train_pct)
    return (
        marked.where(F.col("split") == "train").drop("split"),
        marked.where(F.col("split") == "test").drop("split"),
    )


def assembler(columns: list[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def sample_settings(grid: dict[str, list], n: int, seed: int = SEED) -> list[dict[str, Any]]:
    """``n`` different settings drawn from all combinations, or all if there are fewer."""
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(combinations, min(n, len(combinations)))


@dataclass
class Trained:
    name: str
    model: PipelineModel
    best_params: dict[str, Any]
    cv_rmse: float

    @property
    def estimator(self) -> str:
        return type(self.model.stages[-1]).__name__


@dataclass
class Searched:
    """What a search found: the mean RMSE of every setting, and the best one fitted on all rows."""

    avgMetrics: list[float]
    bestModel: Transformer


def random_search(
    train: DataFrame, name: str, n_iter: int = 10, folds: int = 5, parallelism: int = 4
) -> tuple[Estimator, list[dict[str, Any]], Any]:
    """Cross-validated RMSE of random settings; the folds hang on the customer id."""
    config = MODELS[name]
    settings = sample_settings(config.grid, n_iter)
    estimator = config.build()
    fold = hash_bucket(F.col("CustomerID"), folds, "fold").cast("int")
    ready = assembler().transform(train).select("CustomerID", "features", TARGET, fold.alias("fold"))
    if isinstance(estimator, HistogramBoosting):
        return estimator, settings, _search_boosting(ready, estimator, settings, folds)
    if isinstance(estimator, GBTRegressor):
        means = _boosting_errors(ready, *_as_histograms(estimator, settings), folds)
        best = settings[min(range(len(settings)), key=means.__getitem__)]
        return estimator, settings, Searched(means, config.build(**best).fit(ready))
    if isinstance(estimator, Forest) and (means := estimator.settings_errors(ready, settings, folds, F.col("fold"))):
        best = settings[min(range(len(settings)), key=means.__getitem__)]
        return estimator, settings, Searched(means, config.build(**best).fit(ready))
    grid = [{estimator.getParam(k): v for k, v in s.items()} for s in settings]
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=TARGET, metricName="rmse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    return search, settings, search.fit(ready)


def _as_histograms(estimator: GBTRegressor, settings: list[dict]) -> tuple[HistogramBoosting, list[dict]]:
    """Spark's boosting, a fit of which is hundreds of jobs, said as one whose fits are grown side by side.

    Spark's first tree counts in full, and the others are fitted to twice the residuals, the gradient of the squared error.
    Only bins and the rows drawn for a tree differ.
    """
    take = lambda name: estimator.getOrDefault(estimator.getParam(name))
    same = HistogramBoosting(
        featuresCol=take("featuresCol"), labelCol=take("labelCol"), maxIter=take("maxIter"), stepSize=2 * take("stepSize"), firstStep=1.0,
        numLeaves=0, maxDepth=take("maxDepth"), minChildWeight=0.0, minChildRows=take("minInstancesPerNode"), subsample=take("subsamplingRate"),
        maxBins=take("maxBins"), seed=take("seed"),
    )
    names = {"subsamplingRate": "subsample", "minInstancesPerNode": "minChildRows"}
    return same, [{names.get(k, k): 2 * v if k == "stepSize" else v for k, v in s.items()} for s in settings]


def _search_boosting(ready: DataFrame, estimator: HistogramBoosting, settings: list[dict], folds: int) -> Searched:
    means = _boosting_errors(ready, estimator, settings, folds)
    best = settings[min(range(len(settings)), key=means.__getitem__)]
    return Searched(means, estimator.fit_settings(ready, [(best, -1)], F.col("CustomerID"))[0])


def _boosting_errors(ready: DataFrame, estimator: HistogramBoosting, settings: list[dict], folds: int) -> list[float]:
    """Mean RMSE of every setting: all settings of all folds are grown side by side, and scored where they are grown."""
    key, fold = F.col("CustomerID"), F.col("fold")
    fits = [(s, f) for s in settings for f in range(folds)]
    errors = estimator.settings_errors(ready, fits, key, fold)
    if errors is None:  # too many rows for a task: the models are on the driver
        scored = ready
        for n, model in enumerate(estimator.fit_settings(ready, fits, key, fold)):
            scored = model._set(predictionCol=f"p{n}").transform(scored)
        error = lambda n, f: F.sqrt(F.avg(F.when(fold == f, F.pow(F.col(TARGET) - F.col(f"p{n}"), 2))))
        errors = list(scored.agg(*[error(n, f).alias(f"e{n}") for n, (_, f) in enumerate(fits)]).first())
    held = [errors[n * folds : (n + 1) * folds] for n in range(len(settings))]
    return [sum(e for e in row if e is not None) / max(1, sum(e is not None for e in row)) for row in held]


def search_results(spark: SparkSession, settings: list[dict], fitted: Any) -> DataFrame:
    """One row per tried setting."""
    rows = [(str(s), float(m)) for s, m in zip(settings, fitted.avgMetrics)]
    return spark.createDataFrame(rows, "settings string, cv_rmse double").orderBy("cv_rmse")


def _checkpointed(spark: SparkSession) -> None:
    """The nodes of the rows are updated in every job; without a folder to cut it, their lineage would grow with the trees."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def train_model(train: DataFrame, name: str, tune: bool = True, n_iter: int = 10, **settings: Any) -> Trained:
    if name not in MODELS:
        raise ValueError(f"unknown model: {name}")
    config, vectors = MODELS[name], assembler()
    _checkpointed(train.sparkSession)
    if tune and config.grid:
        _, tried, fitted = random_search(train, name, n_iter)
        best = min(range(len(tried)), key=lambda i: fitted.avgMetrics[i])
        model = PipelineModel([vectors, fitted.bestModel])
        return Trained(name, model, tried[best], float(fitted.avgMetrics[best]))
    fitted = config.build(**settings).fit(vectors.transform(train))
    return Trained(name, PipelineModel([vectors, fitted]), settings, 0.0)


def train_all(
    train: DataFrame, tune: bool = True, n_iter: int = 10, names: list[str] | None = None, parallelism: int = 3,
    settings: dict[str, dict] | None = None,
) -> list[Trained]:
    """Several models, all six unless named; a few are fitted side by side to keep the cluster busy.

    ``settings`` by name hold for untuned fits. The training rows are written once; boosting alone reads them hundreds of times.
    """
    base = written(train, "train")
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda name: train_model(base, name, tune, n_iter, **(settings or {}).get(name, {})), names or MODELS))


def metrics(predictions: DataFrame, predicted: str = "prediction", actual: str = TARGET) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (over positive actuals, 0 if there are none) in one pass."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    relative = F.avg(F.when(y > 0, F.abs(error / F.nullif(y, F.lit(0.0)))))
    unexplained = ratio(F.sum(error * error), F.var_pop(y) * F.count(y))
    return predictions.agg(
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (F.lit(1.0) - unexplained).alias("R2"),
        F.coalesce(relative * 100, F.lit(0.0)).alias("MAPE"),
    )


def compare(rows: list[DataFrame]) -> DataFrame:
    """Metric rows of several models, best first."""
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.orderBy(F.desc("R2"), "Model")


def evaluate(trained: list[Trained], test: DataFrame) -> DataFrame:
    """One row per model by R2. All models score the test rows in one job."""
    return compare([
        metrics(t.model.transform(test)).select(
            F.lit(t.name).alias("Model"), F.lit(t.estimator).alias("Estimator"), "MAE", "RMSE", "R2", "MAPE"
        )
        for t in trained
    ])


REGISTRY = "seq bigint, name string, path string, MAE double, RMSE double, R2 double, MAPE double"


def _claimed(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there already; whoever creates it first has it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if system.getScheme() == "file":  # Hadoop looks and then creates there, which is no claim
        try:
            with open(target.toUri().getPath(), "x", encoding="utf-8") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if system.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _entries(spark: SparkSession, folder: str) -> list[int]:
    """The numbers taken so far, from the names of the entries' files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def register(spark: SparkSession, folder: str, name: str, path: str, scores: dict[str, float]) -> int:
    """Append an entry and return its number; the newest of a name counts.

    An entry is a file of its own, named by its number and created only if no other writer has: several may register at
    the same time, and each gets a number of its own.
    """
    while True:
        number = max(_entries(spark, folder), default=0) + 1
        entry = {"seq": number, "name": name, "path": path, **{m: float(scores[m]) for m in ("MAE", "RMSE", "R2", "MAPE")}}
        if _claimed(spark, f"{folder.rstrip('/')}/{number:012d}.json", json.dumps(entry) + "\n"):
            return number


def read_registry(spark: SparkSession, folder: str) -> DataFrame | None:
    return spark.read.schema(REGISTRY).option("allowNonNumericNumbers", True).json(folder) if _entries(spark, folder) else None


def current_models(entries: DataFrame) -> DataFrame:
    """The newest entry of each name."""
    newest = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("seq")))
    return entries.withColumn("_age", newest).where("_age = 1").drop("_age")


def best_model(entries: DataFrame) -> DataFrame:
    """Highest R2; the earlier entry wins a tie."""
    return current_models(entries).orderBy(F.desc("R2"), "seq").limit(1)


def save_model(trained: Trained, folder: str, scores: dict[str, float]) -> str:
    """Save under ``folder`` and enter it in the registry beside it."""
    spark = SparkSession.active()
    path = f"{folder}/models/{trained.name}"
    trained.model.write().overwrite().save(path)
    register(spark, f"{folder}/registry", trained.name, path, scores)
    return path


def load_best(spark: SparkSession, folder: str) -> tuple[str, PipelineModel]:
    entries = read_registry(spark, f"{folder}/registry")
    if entries is None:
        raise FileNotFoundError(f"no model registry under {folder}")
    best = best_model(entries).first()
    return best["name"], PipelineModel.load(best["path"])


def feature_importance(spark: SparkSession, model: Transformer, names: list[str] = FEATURES) -> DataFrame:
    """Signed coefficients or tree importances, largest first; one row per feature. A model without either has zeros."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    weights = getattr(last, "coefficients", None) or getattr(last, "featureImportances", None)
    values = weights.toArray() if weights is not None else [0.0] * len(names)
    rows = [(n, float(w)) for n, w in zip(names, values)]
    return spark.createDataFrame(rows, "Feature string, Importance double").orderBy(F.desc("Importance"), "Feature")


def residuals(predictions: DataFrame, predicted: str = "prediction", actual: str = TARGET) -> DataFrame:
    return predictions.select(
        "CustomerID",
        F.col(actual).alias("actual"),
        F.col(predicted).alias("predicted"),
        (F.col(actual) - F.col(predicted)).alias("residual"),
    )


def permutation_importance(model: Transformer, test: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """How much the RMSE grows when one feature is dealt to other customers.

    One shuffle of the customers serves all features: the rows are put in two
    hash orders and paired by position. Every row then appears once per feature
    with that feature swapped, and one pass scores them all.
    """
    key = F.col("CustomerID")

    def dealt(salt: str, rows: DataFrame) -> DataFrame:
        order = F.md5(F.concat(key, F.lit(salt)))
        hashed = rows.withColumn("_hash", order)
        return global_row_number(hashed, [F.asc("_hash"), F.asc("CustomerID")], "_seat").drop("_hash")

    base = written(test.select("CustomerID", *names, TARGET), "permuted")
    other = dealt("other", base.select("CustomerID", *names)).select(
        "_seat", *[F.col(c).alias(f"_{c}") for c in names]
    )
    paired = dealt("own", base).join(other, "_seat")
    swapped = F.explode(F.array(F.lit(""), *[F.lit(c) for c in names])).alias("Feature")
    trials = paired.select("*", swapped).select(
        "Feature", TARGET, *[F.when(F.col("Feature") == c, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names]
    )
    error = F.col(TARGET) - F.col("prediction")
    scored = model.transform(trials).groupBy("Feature").agg(F.sqrt(F.avg(error * error)).alias("RMSE"))
    baseline = F.max(F.when(F.col("Feature") == "", F.col("RMSE"))).over(Window.partitionBy())
    return (
        scored.withColumn("Importance", F.col("RMSE") - baseline)
        .where(F.col("Feature") != "")
        .orderBy(F.desc("Importance"), "Feature")
    )
