"""Classifiers on Spark ML: grids, random search, threshold choice, importance, run records."""

from __future__ import annotations

import json
import math
import random
from contextlib import nullcontext
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Semaphore

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.ml import evaluation as E
from churnlake.ml.encode import with_vector
from churnlake.ml.smote import Neighbours, balance, shared_neighbours
from churnlake.operators.ordering import By, row_rank
from churnlake.session import stage

# Parameter grids and the number of random draws from each.
GRIDS = {
    "Logistic Regression": {
        "C": [0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0],
        "class_weight": [None, "balanced"],
    },
    "Random Forest": {
        "n_estimators": [100, 200, 300, 400, 500],
        "max_depth": [None, 5, 8, 12, 16],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2", None],
    },
    "Gradient Boosting": {
        "n_estimators": [100, 200, 300, 400, 600],
        "learning_rate": [0.01, 0.03, 0.05, 0.08, 0.1],
        "max_depth": [2, 3, 4, 5],
        "subsample": [0.7, 0.85, 1.0],
        "min_samples_leaf": [1, 2, 4],
    },
    "Weighted GBT": {
        "n_estimators": [200, 300, 500, 700, 1000],
        "learning_rate": [0.005, 0.01, 0.03, 0.05, 0.08, 0.1],
        "max_depth": [3, 4, 5, 6],
        "subsample": [0.7, 0.8, 0.9, 1.0],
        "column_share": [0.7, 0.8, 0.9, 1.0],
        "min_samples_leaf": [1, 3, 5, 7],
        "positive_weight": [1.0, 2.6],
    },
    "Column-Sampled GBT": {
        "n_estimators": [200, 400, 600, 800, 1000],
        "learning_rate": [0.005, 0.01, 0.03, 0.05, 0.1],
        "max_depth": [3, 5, 7],
        "subsample": [0.7, 0.85, 1.0],
        "column_share": [0.7, 0.85, 1.0],
        "min_samples_leaf": [5, 10, 20],
    },
}
DRAWS = {"Logistic Regression": 20, "Random Forest": 30, "Gradient Boosting": 30,
         "Weighted GBT": 48, "Column-Sampled GBT": 48}
EXPORT_PRIORITY = ("Weighted GBT", "Column-Sampled GBT", "Gradient Boosting", "Random Forest")
DEEPEST = 16                      # stands for an unlimited depth
SEARCH_METRICS = ("accuracy", "roc_auc", "f1", "precision", "recall")
#: Rows that a task has at least in a pass of a logistic fit, which makes about a hundred.
ROWS_IN_TASK = 100_000
#: Moved rows that a task makes and counts when features are permuted; a fifth of it are ranked by a task.
ROWS_MOVED = 500_000
#: Training rows that all models fitted side by side hold together, beyond the asked number of models.
ROWS_AT_ONCE = 1_000_000


def draw_parameters(grid: dict[str, list], draws: int, seed: int = 42) -> list[dict]:
    """Different random points of a grid, by number, so that the grid is never listed."""
    size = 1
    for values in grid.values():
        size *= len(values)
    points = []
    for number in random.Random(seed).sample(range(size), min(draws, size)):
        point = {}
        for name, values in grid.items():
            number, i = divmod(number, len(values))
            point[name] = values[i]
        points.append(point)
    return points


def class_sizes(train: DataFrame) -> dict[int, int]:
    return {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}


def class_weights(train: DataFrame, params: dict, sizes: dict[int, int]) -> DataFrame:
    """Add ``weight``: balanced, a positive weight, or 1."""
    if params.get("class_weight") == "balanced":
        total = sum(sizes.values())
        weight = F.when(F.col("label") == 1, total / (2.0 * sizes.get(1, 1))).otherwise(total / (2.0 * sizes.get(0, 1)))
    else:
        weight = F.when(F.col("label") == 1, float(params.get("positive_weight", 1.0))).otherwise(1.0)
    return train.withColumn("weight", weight)


def estimator(name: str, params: dict, rows: int, seed: int = 42):
    common = dict(labelCol="label", weightCol="weight")
    if name == "Logistic Regression":
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
        model = LogisticRegression(featuresCol="scaled", maxIter=int(params.get("max_iter", 100)),
                                   regParam=1.0 / (float(params.get("C", 1.0)) * max(rows, 1)),
                                   standardization=False, **common)
        return Pipeline(stages=[scaler, model])
    trees = dict(featuresCol="features", seed=seed, maxDepth=int(params.get("max_depth") or DEEPEST),
                 minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
                 subsamplingRate=float(params.get("subsample", 1.0)), **common)
    if name == "Random Forest":
        return Pipeline(stages=[RandomForestClassifier(
            numTrees=int(params.get("n_estimators", 100)), featureSubsetStrategy=params.get("max_features") or "all", **trees)])
    return Pipeline(stages=[GBTClassifier(
        maxIter=int(params.get("n_estimators", 100)), stepSize=float(params.get("learning_rate", 0.1)),
        featureSubsetStrategy=str(params.get("column_share", "all")), **trees)])


def fit(train: DataFrame, name: str, params: dict, seed: int = 42, sizes: dict[int, int] | None = None) -> PipelineModel:
    """``train`` has label and the vector ``features``; it is read once per iteration, so store it.

    A fitted model holds a summary of its training, and that the session, which tasks that score must not be sent.
    The summary is let go, as it is when a model is saved and loaded.
    """
    sizes = class_sizes(train) if sizes is None else sizes
    rows = sum(sizes.values())
    if name == "Logistic Regression":
        train = train.coalesce(max(1, math.ceil(rows / ROWS_IN_TASK)))
    model = estimator(name, params, rows, seed).fit(class_weights(train, params, sizes))
    for step in model.stages:
        if getattr(step, "hasSummary", False):
            step._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def fit_in_turn(turns: Semaphore | None, *args, **options) -> PipelineModel:
    """``fit`` once one of the ``turns`` is free, which bound the fits at a time over all searches."""
    with turns or nullcontext():
        return fit(*args, **options)


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the churn probability; helper columns are dropped."""
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return out.drop("rawPrediction", "probability", "prediction", "scaled")


def metric_values(scored: DataFrame, metric: str, group: str, threshold: float = 0.5) -> dict:
    """The metric of every group of scored rows, in one aggregation. ``scored`` is stored."""
    if metric not in SEARCH_METRICS:
        raise ValueError(f"metric must be one of {SEARCH_METRICS}")
    if metric == "roc_auc":
        return {r[group]: r["roc_auc"] or 0.0 for r in E.auc(scored, group=group).collect()}
    column = {"f1": "f1_score"}.get(metric, metric)
    return {r[group]: r[column] for r in E.binary_metrics(scored, threshold, group=group).collect()}


def prepare(train: DataFrame, use_smote: bool, shared: Neighbours | None = None) -> DataFrame:
    """Training rows as stored vectors, balanced if wanted; ``shared`` neighbours serve several samples of a table."""
    rows = balance(train, shared=shared) if use_smote else train.select("customer_id", "x", "label", F.lit(False).alias("synthetic"))
    return stage(with_vector(rows), "train")


def prepare_folds(folded: DataFrame, use_smote: bool, folds: int = 5, parallelism: int = 1, shared: Neighbours | None = None) -> list[DataFrame]:
    """The training rows of each fold: all others', stored and balanced if wanted, by neighbours searched for once."""
    if use_smote and shared is None and folds > 1:
        shared = shared_neighbours(folded)

    def one(fold: int) -> DataFrame:
        return prepare(folded.filter(F.col("fold") != fold), use_smote, shared)

    return [one(f) for f in range(folds)] if parallelism == 1 else in_parallel(folded.sparkSession, one, list(range(folds)), parallelism)


def fits_at_once(spark: SparkSession, rows: int, parallelism: int) -> int:
    """``parallelism`` models, or as many as there are cores if their training ``rows`` are few.

    A pass over a small table is one task, so a model that is fitted in hundreds of passes keeps one core busy.
    """
    return max(parallelism, min(spark.sparkContext.defaultParallelism, ROWS_AT_ONCE // max(rows, 1)))


def in_parallel(spark: SparkSession, work, jobs: list, parallelism: int) -> list:
    """Results in order of ``jobs``; Spark runs the jobs of several threads side by side."""
    if parallelism == 1:
        return [work(j) for j in jobs]
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(work), jobs, chunksize=1)


def scored_trials(held: DataFrame, models: list[PipelineModel], first: int) -> DataFrame:
    """(trial, label, score): every row of ``held`` by every model, in one pass. Trials are numbered from ``first``."""
    rows = with_vector(held)
    for i, model in enumerate(models):
        rows = score(model, rows, f"score_{i}")
    scores = F.array(*[f"score_{i}" for i in range(len(models))])
    return rows.select("label", F.posexplode(scores).alias("trial", "score")).withColumn("trial", F.col("trial") + first)


def random_search(folded: DataFrame, name: str, points: list[dict], metric: str = "accuracy", use_smote: bool = True,
                  folds: int = 5, seed: int = 42, parallelism: int = 4,
                  trains: list[DataFrame] | None = None, turns: Semaphore | None = None) -> list[tuple[dict, float]]:
    """Mean metric per parameter point over the folds, best first; ties keep drawing order.

    Oversampling happens inside each training fold, once per fold for all points; ``trains`` are the prepared folds
    if they serve several searches. ``parallelism`` models, of few rows as many as ``fits_at_once``, are fitted side by
    side, and four times as many held at a time; those of a fold score its held rows in one frame, and all trials are
    measured together. Searches that run side by side share the ``turns`` of their fits.
    """
    trains = trains or prepare_folds(folded, use_smote, folds)
    sizes = [class_sizes(train) for train in trains]
    parallelism = fits_at_once(folded.sparkSession, max(sum(s.values()) for s in sizes), parallelism) if parallelism > 1 else 1
    jobs = [(fold, i) for fold in range(folds) for i in range(len(points))]
    trials = None
    for start in range(0, len(jobs), 4 * parallelism):
        some = jobs[start:start + 4 * parallelism]
        models = in_parallel(folded.sparkSession, lambda job: fit_in_turn(turns, trains[job[0]], name, points[job[1]], seed, sizes[job[0]]), some, parallelism)
        for fold in sorted({f for f, _ in some}):
            mine = [(i, model) for (f, i), model in zip(some, models) if f == fold]
            held = scored_trials(folded.filter(F.col("fold") == fold), [m for _, m in mine], fold * len(points) + mine[0][0])
            trials = stage(held, "trials") if trials is None else trials.unionByName(stage(held, "trials"))
    values = metric_values(trials, metric, "trial")
    means = [(p, sum(values.get(fold * len(points) + i, 0.0) for fold in range(folds)) / folds) for i, p in enumerate(points)]
    return sorted(means, key=lambda m: -m[1])


def feature_importance(model: PipelineModel, names: list[str], top: int = 15) -> list[tuple[str, float]]:
    """Largest importances of a tree model."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return []
    ranked = sorted(zip(names, last.featureImportances.toArray().tolist()), key=lambda p: (-p[1], p[0]))
    return ranked[:top]


def contributions(model: PipelineModel, names: list[str]) -> dict:
    """Coefficient times standardised value per feature, of a logistic model over ``x``."""
    scaler, logistic = model.stages[0], model.stages[-1]
    parts = zip(names, scaler.mean.toArray(), scaler.std.toArray(), logistic.coefficients.toArray())
    return {n: (F.get("x", F.lit(i)) - float(m)) * float(c / s if s else 0.0)
            for i, (n, m, s, c) in enumerate(parts)}


def log_odds(model: PipelineModel, names: list[str]) -> Column:
    """What the contributions and the intercept add up to: the log-odds of the score."""
    return sum(contributions(model, names).values(), F.lit(float(model.stages[-1].intercept)))


def permuted(df: DataFrame, features: list[int], seed: int = 42) -> DataFrame:
    """Every row once as it is (``feature`` -1) and once per feature with that value taken from another row.

    The other row is the next in hash order, the first for the last: a permutation of each feature's values.
    """
    hashed = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}|"), "customer_id")))
    ranked = stage(row_rank(hashed, By("__h"), "customer_id", name="__r", rows_per_bucket=ROWS_MOVED // 5), "hash-order")
    rows = ranked.count()
    donors = ranked.select((F.pmod(F.col("__r"), F.lit(max(rows, 1))) + 1).alias("__r"), F.col("x").alias("__donor"))
    tasks = math.ceil(rows * (len(features) + 1) / ROWS_MOVED)
    pairs = ranked.join(donors, "__r")
    pairs = pairs.repartition(tasks, "__r") if tasks > 1 else pairs
    every = pairs.withColumn("feature", F.explode(F.array(*[F.lit(i) for i in [-1, *features]])))
    x = F.transform("x", lambda v, i: F.when(i == F.col("feature"), F.get("__donor", F.col("feature"))).otherwise(v))
    return every.select("customer_id", "label", "feature", x.alias("x"))


def permutation_importance(model: PipelineModel, df: DataFrame, names: list[str], features: list[str] | None = None,
                           seed: int = 42) -> list[tuple[str, float]]:
    """Loss of ROC-AUC when a feature's values are moved between rows; all features in one pass. ``df`` is stored."""
    asked = [names.index(n) for n in (features or names)]
    areas = metric_values(score(model, with_vector(permuted(df, asked, seed))), "roc_auc", "feature")
    losses = [(names[i], areas.get(-1, 0.0) - areas.get(i, 0.0)) for i in asked]
    return sorted(losses, key=lambda p: (-p[1], p[0]))


@dataclass
class ModelResult:
    """A trained model, its numbers, and its scores (customer_id, label, score) of held-out and of test rows."""

    name: str
    params: dict
    metrics: dict
    model: PipelineModel | None = field(default=None, repr=False)
    held: DataFrame | None = field(default=None, repr=False)
    test: DataFrame | None = field(default=None, repr=False)


def _numbers(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/numbers")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def clear_result(spark: SparkSession, path: str) -> None:
    """Make the checkpoint incomplete, so that the next run trains again."""
    folder, files = _numbers(spark, path)
    files.delete(folder, True)


def save_result(spark: SparkSession, result: ModelResult, path: str, asked: dict | None = None) -> None:
    """Model and scores first, then the numbers: their ``_SUCCESS`` file, written last, makes the checkpoint complete.

    ``asked`` says what was trained: settings that must be the same for the checkpoint to be used.
    """
    clear_result(spark, path)
    result.model.write().overwrite().save(f"{path}/model")
    for name in ("held", "test"):
        scores = getattr(result, name)
        if scores is not None:
            scores.write.mode("overwrite").parquet(f"{path}/{name}")
    line = json.dumps({"name": result.name, "params": result.params, "metrics": result.metrics, "asked": asked,
                       "scores": [n for n in ("held", "test") if getattr(result, n) is not None]})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/numbers")


def load_result(spark: SparkSession, path: str, asked: dict | None = None) -> ModelResult | None:
    """The saved result, or None if there is no complete one of the same settings."""
    folder, files = _numbers(spark, path)
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        return None
    saved = json.loads(spark.read.text(f"{path}/numbers").first()["value"])
    if asked is not None and saved["asked"] != json.loads(json.dumps(asked)):
        return None
    scores = {n: spark.read.parquet(f"{path}/{n}") for n in saved["scores"]}
    return ModelResult(saved["name"], saved["params"], saved["metrics"], PipelineModel.load(f"{path}/model"), **scores)


def record_run(spark: SparkSession, path: str, run: dict, results: list[ModelResult]) -> DataFrame:
    """Put one run into the history: a row per model with metrics, parameters and run data.

    The run's folder is overwritten, so a run that is recorded again is replaced, and other runs stay. A version is
    the time of training; ``test_size`` counts the rows the metrics were measured on.
    """
    rows = [tuple(r.metrics.get(c) for c in _METRIC_NAMES) + (r.metrics.get("test_size"), r.name, json.dumps(r.params, sort_keys=True))
            for r in results]
    schema = ", ".join(f"{c} double" for c in _METRIC_NAMES) + ", test_size long, model_name string, hyperparameters string"
    created = F.lit(run["created_at"]).cast("timestamp_ntz")
    table = spark.createDataFrame(rows, schema).withColumns({
        "metric": F.lit(run["metric"]), "use_smote": F.lit(run["use_smote"]), "seed": F.lit(run["seed"]),
        "created_at": created, "training_date": created, "model_version": F.date_format(created, "yyyyMMdd.HHmmss"),
        "run_id": F.lit(run["run_id"])})
    (table.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))
    return spark.read.parquet(path)


_METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "best_threshold", "threshold_accuracy", "cv_score"]


def run_name(name: str | None, created_at: str, metric: str, use_smote: bool) -> str:
    """The given name with underscores, or time, metric and oversampling."""
    if name:
        return name.strip().replace(" ", "_")
    stamp = created_at.replace("-", "").replace(":", "").replace(" ", "_")
    return f"{stamp}_{metric}_{'smote' if use_smote else 'no_smote'}"
