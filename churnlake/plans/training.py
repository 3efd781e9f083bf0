"""The whole modelling run: split, encode, search, threshold, evaluate, vote, record."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from threading import Semaphore

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.ml import encode, ensemble, evaluation as E, split, training as T
from churnlake.ml.smote import shared_neighbours
from churnlake.operators import features as FE
from churnlake.session import stage


@dataclass
class Dataset:
    """Stored train and test rows: customer_id, label, feature array ``x``."""

    train: DataFrame
    test: DataFrame
    names: list[str]


def make_dataset(customers: DataFrame, seed: int = 42, fit_on_train: bool = True) -> Dataset:
    """Stratified 80/20 split, then features and categories fitted on the training rows."""
    marked = stage(split.stratified_split(
        customers.withColumn("label", F.when(F.col("churn") == "Yes", 1).otherwise(0)), "label", seed=seed), "split")
    train_rows = marked.filter("is_train")
    full = FE.customer_features(marked, fit_on=train_rows if fit_on_train else None)
    train, test = full.filter("is_train"), full.filter("NOT is_train")
    categories = encode.fit_categories(train, FE.CATEGORICAL_FEATURES)
    both = [stage(encode.to_features(df, FE.NUMERIC_FEATURES, categories, ["customer_id", "label"]).drop("features"), name)
            for df, name in ((train, "train-x"), (test, "test-x"))]
    return Dataset(both[0], both[1], encode.feature_names(FE.NUMERIC_FEATURES, categories))


def measured(scored: DataFrame, threshold: float) -> dict:
    row = E.binary_metrics(scored, threshold).first()
    return {c: row[c] for c in ("accuracy", "precision", "recall", "f1_score")} | {
        "roc_auc": E.auc(scored).first()["roc_auc"], "test_size": sum(row[c] for c in ("tp", "fp", "tn", "fn"))}


def tuned_threshold(scored: DataFrame, limits: tuple[int, int] = E.MODEL_THRESHOLDS) -> tuple[float, float]:
    best = E.best_threshold(E.threshold_sweep(scored, limits)).first()
    return best["threshold"], best["accuracy"]


def scores_of(model, rows: DataFrame) -> DataFrame:
    return stage(T.score(model, encode.with_vector(rows)).select("customer_id", "label", "score"), "scored")


def score_column(model: str) -> str:
    return "score_" + model.replace(" ", "_").replace("-", "_").lower()


def side_by_side(scores: dict[str, DataFrame]) -> DataFrame:
    """customer_id, label and a score column per model, from the models' own score tables, in one aggregation."""
    long = None
    for model, rows in scores.items():
        one = rows.select("customer_id", "label", F.lit(model).alias("model"), "score")
        long = one if long is None else long.unionByName(one)
    return long.groupBy("customer_id", "label").agg(
        *[F.max(F.when(F.col("model") == m, F.col("score"))).alias(score_column(m)) for m in scores])


def train_and_evaluate(data: Dataset, models: list[str] | None = None, grids: dict | None = None,
                       draws: dict | None = None, metric: str = "accuracy", use_smote: bool = True, folds: int = 5,
                       seed: int = 42, checkpoints: str | None = None, clear_checkpoints: bool = False,
                       parallelism: int = 4) -> tuple[list[T.ModelResult], DataFrame]:
    """Results, best first by accuracy then ROC-AUC, and the test rows with every score.

    With ``checkpoints`` a model that was finished with the same settings is loaded, scores included, instead of
    trained again; ``clear_checkpoints`` trains all anew. Searches run side by side, with the two last fits of each, and
    take turns: ``parallelism`` models, of few rows as many as ``fits_at_once``, are fitted at a time. Folds are balanced
    side by side, by neighbours that are searched for once in all training rows.
    """
    spark = data.train.sparkSession
    grids, draws = grids or T.GRIDS, draws or T.DRAWS
    names = models or list(grids)
    paths = {n: f"{checkpoints}/{n.replace(' ', '_').lower()}" if checkpoints else None for n in names}
    asked = {n: {"grid": grids[n], "draws": draws[n], "metric": metric, "use_smote": use_smote, "folds": folds, "seed": seed} for n in names}
    if clear_checkpoints:
        for path in filter(None, paths.values()):
            T.clear_result(spark, path)
    results = [T.load_result(spark, paths[n], asked[n]) if paths[n] else None for n in names]
    if None in results:
        inner = stage(split.stratified_split(data.train, "label", seed=seed + 1), "inner")
        fit_part, held = inner.filter("is_train").drop("is_train"), inner.filter("NOT is_train").drop("is_train")
        folded = stage(split.stratified_folds(data.train, "label", folds=folds, seed=seed), "folds")
        at_once = T.fits_at_once(spark, data.train.count(), parallelism) if parallelism > 1 else 1
        shared = shared_neighbours(data.train) if use_smote else None
        fit_rows, all_rows = T.in_parallel(spark, lambda rows: T.prepare(rows, use_smote, shared), [fit_part, data.train], min(2, at_once))
        trains = T.prepare_folds(folded, use_smote, folds, min(folds, at_once), shared)
        turns = Semaphore(at_once)

        def trained(name: str) -> T.ModelResult:
            params, cv = T.random_search(folded, name, T.draw_parameters(grids[name], draws[name], seed), metric,
                                         use_smote, folds, seed, parallelism, trains, turns)[0]
            model, partial = T.in_parallel(spark, lambda rows: T.fit_in_turn(turns, rows, name, params, seed), [all_rows, fit_rows], min(2, parallelism))
            on_held, on_test = scores_of(partial, held), scores_of(model, data.test)
            threshold, reached = tuned_threshold(on_held)
            result = T.ModelResult(name, params, measured(on_test, threshold) | {
                "best_threshold": threshold, "threshold_accuracy": reached, "cv_score": cv}, model, on_held, on_test)
            if paths[name]:
                T.save_result(spark, result, paths[name], asked[name])
            return result

        open_ = [i for i, result in enumerate(results) if result is None]
        for i, result in zip(open_, T.in_parallel(spark, trained, [names[i] for i in open_], min(len(open_), at_once))):
            results[i] = result
    test = stage(side_by_side({r.name: r.test for r in results}), "test-scores")
    validation = stage(side_by_side({r.name: r.held for r in results}), "held-scores")
    members = ensemble.choose_members({r.name: r.metrics["threshold_accuracy"] for r in results})
    areas = {r.name: r.metrics["roc_auc"] for r in results}
    chosen = {m: score_column(m) for m in members}
    voted = stage(ensemble.soft_vote(test, chosen, areas, "score"), "voted")
    on_held = stage(ensemble.soft_vote(validation, chosen, areas, "score").select("label", "score"), "voted-held")
    threshold, reached = tuned_threshold(on_held, E.ENSEMBLE_THRESHOLDS)
    total = sum(areas[m] for m in members)
    cv = [r.metrics["cv_score"] for r in results if r.name in members]
    results.append(T.ModelResult(
        "Soft Voting Ensemble", {"members": members, "weights": [areas[m] / total for m in members]},
        measured(voted, threshold) | {"best_threshold": threshold, "threshold_accuracy": reached,
                                      "cv_score": sum(cv) / len(cv)}))
    results.sort(key=lambda r: (-r.metrics["accuracy"], -r.metrics["roc_auc"]))
    return results, voted.withColumnRenamed("score", "score_soft_voting_ensemble")


def run(customers: DataFrame, history: str, name: str | None = None, created_at: str | None = None,
        metric: str = "accuracy", use_smote: bool = True, seed: int = 42, **options,
        ) -> tuple[list[T.ModelResult], DataFrame, T.ModelResult]:
    """Train, record the run under ``history`` and return results, test scores, export model."""
    created_at = created_at or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    data = make_dataset(customers, seed)
    results, scores = train_and_evaluate(data, metric=metric, use_smote=use_smote, seed=seed, **options)
    run_id = T.run_name(name, created_at, metric, use_smote)
    table = T.record_run(customers.sparkSession, history, {
        "run_id": run_id, "metric": metric, "use_smote": use_smote, "seed": seed, "created_at": created_at}, results)
    chosen = ensemble.select_export_model(table.filter(F.col("run_id") == run_id), T.EXPORT_PRIORITY).first()["model_name"]
    return results, scores, next(r for r in results if r.name == chosen)
