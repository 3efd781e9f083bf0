"""Search, checkpoints, history and explanations of models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.ml import encode, evaluation, split, training as T
from churnlake.operators import store
from churnlake.plans import training as plan
from churnlake.session import new_path, stage

LOGISTIC = {"Logistic Regression": {"C": [0.1, 1.0], "class_weight": [None, "balanced"]}}


@pytest.fixture(scope="module")
def data(customers):
    return plan.make_dataset(customers)


def test_split_has_no_window(customers):
    marked = split.stratified_split(customers, "churn")
    plan_text = marked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan_text and "Exchange" not in plan_text
    few = stage(customers.limit(7))
    assert split.stratified_split(few, "churn", rows_in_task=2).filter("is_train").count() == sum(
        int(0.8 * r["count"] + 0.5) for r in few.groupBy("churn").count().collect())


def test_split_of_many_rows_in_small_brackets(customers):
    got = {r["customer_id"] for r in split.stratified_split(customers, "churn", rows_in_task=50).filter("is_train").collect()}
    assert got == {r["customer_id"] for r in split.stratified_split(customers, "churn").filter("is_train").collect()}


def test_search_scores_every_held_row_by_every_point(data):
    """Against a plain loop: fit, score and measure one point and fold after the other."""
    folded = stage(split.stratified_folds(data.train, "label", folds=3))
    points = T.draw_parameters(LOGISTIC["Logistic Regression"], 4)
    found = {str(p): v for p, v in T.random_search(folded, "Logistic Regression", points, "roc_auc", False, 3, parallelism=3)}
    for p in points[:2]:
        areas = []
        for fold in range(3):
            model = T.fit(stage(encode.with_vector(folded.filter(F.col("fold") != fold))), "Logistic Regression", p)
            areas.append(evaluation.auc(plan.scores_of(model, folded.filter(F.col("fold") == fold))).first()["roc_auc"])
        assert found[str(p)] == pytest.approx(sum(areas) / 3, abs=1e-9)
    assert len(found) == 4


def test_second_run_trains_nothing(data, spark, monkeypatch):
    fits, real = [], T.fit
    monkeypatch.setattr(T, "fit", lambda *a, **b: fits.append(1) or real(*a, **b))
    folder = new_path(spark, "resume")

    def run(**more):
        fits.clear()
        options = {"grids": LOGISTIC, "draws": {"Logistic Regression": 1}, "use_smote": False, "folds": 2, "checkpoints": folder} | more
        results, scores = plan.train_and_evaluate(data, **options)
        return len(fits), [r.metrics for r in results], sorted(map(tuple, scores.collect()))

    trained, metrics, scores = run()
    assert trained == 4                                    # two folds, the threshold model and the final one
    assert run() == (0, metrics, scores)
    assert run(clear_checkpoints=True)[0] == 4
    assert run(seed=7)[0] == 4 and run(seed=7)[0] == 0     # of other settings: not this checkpoint
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/logistic_regression/numbers/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert run(seed=7)[0] == 4                             # half written


def test_history_replaces_a_run_and_keeps_others(spark):
    path = new_path(spark, "history")

    def record(run, at, accuracy):
        return T.record_run(spark, path, {"run_id": run, "metric": "accuracy", "use_smote": True, "seed": 1, "created_at": at},
                            [T.ModelResult(m, {"C": 1.0}, {"accuracy": accuracy + i / 10, "roc_auc": 0.7, "test_size": 9})
                             for i, m in enumerate(("a", "b"))])

    record("one", "2024-01-01 10:00:00", 0.1)
    record("two", "2024-01-02 10:00:00", 0.5)
    history = record("one", "2024-01-01 10:00:00", 0.3)
    rows = {(r["run_id"], r["model_name"], r["leaderboard_rank"], r["accuracy"]) for r in store.model_leaderboard(history).collect()}
    assert rows == {("one", "b", 1, 0.4), ("one", "a", 2, 0.3), ("two", "b", 1, 0.6), ("two", "a", 2, 0.5)}
    latest = {(r["model_name"], r["model_version"], r["test_size"]) for r in store.latest_model_versions(history).collect()}
    assert latest == {(m, v, 9) for m in "ab" for v in ("20240101.100000", "20240102.100000")}


def test_permutation_moves_one_feature_at_a_time(data):
    rows = {r["customer_id"]: r["x"] for r in data.test.collect()}
    moved = T.permuted(data.test, [0, 3]).collect()
    assert len(moved) == 3 * len(rows)
    for feature in (-1, 0, 3):
        got = {r["customer_id"]: r["x"] for r in moved if r["feature"] == feature}
        for c, x in got.items():
            assert [v for i, v in enumerate(x) if i != feature] == [v for i, v in enumerate(rows[c]) if i != feature]
        assert np.array_equal(sorted(x[0] for x in got.values()), sorted(x[0] for x in rows.values()))
        if feature >= 0:
            assert any(got[c][feature] != rows[c][feature] for c in rows)


def test_models_can_be_staged_after_training(data):
    """A fitted model must not carry the session into the tasks that score."""
    for name, params in (("Logistic Regression", {"C": 1.0}), ("Random Forest", {"n_estimators": 3, "max_depth": 3})):
        model = T.fit(stage(encode.with_vector(data.train)), name, params)
        assert not any(getattr(step, "hasSummary", False) for step in model.stages)
        assert plan.scores_of(model, data.test).count() == data.test.count()


def test_models_of_few_rows_are_fitted_on_all_cores(data, spark, monkeypatch):
    """Small tables: as many models at a time as there are cores, with the values of one after the other."""
    assert T.fits_at_once(spark, 1_000, 2) == spark.sparkContext.defaultParallelism
    assert T.fits_at_once(spark, 10**9, 2) == 2
    asked, real = [], T.in_parallel
    monkeypatch.setattr(T, "in_parallel", lambda s, work, jobs, n: asked.append(n) or real(s, work, jobs, n))
    folded = stage(split.stratified_folds(data.train, "label", folds=2))
    points = T.draw_parameters(LOGISTIC["Logistic Regression"], 2)
    several = T.random_search(folded, "Logistic Regression", points, "roc_auc", False, 2, parallelism=2)
    assert asked == [spark.sparkContext.defaultParallelism]
    assert several == T.random_search(folded, "Logistic Regression", points, "roc_auc", False, 2, parallelism=1)


def test_permuted_rows_are_dealt_to_bounded_tasks(data, monkeypatch):
    """No task makes more moved rows than allowed, whatever it got; the rows are the same."""
    want = sorted(map(tuple, T.permuted(data.test, [0, 3]).collect()))
    monkeypatch.setattr(T, "ROWS_MOVED", 100)
    moved = T.permuted(data.test, [0, 3])
    assert moved.rdd.getNumPartitions() >= len(want) / 100
    assert sorted(map(tuple, moved.collect())) == want


def test_models_of_few_rows_are_trained_side_by_side(data, monkeypatch):
    """Folds are prepared and searches run at the same time, with the results of one after the other."""
    asked, real = [], T.in_parallel
    monkeypatch.setattr(T, "in_parallel", lambda s, work, jobs, n: asked.append((len(jobs), n)) or real(s, work, jobs, n))
    options = {"grids": {"Logistic Regression": {"C": [1.0]}, "Random Forest": {"n_estimators": [2], "max_depth": [2]}},
               "draws": {"Logistic Regression": 1, "Random Forest": 1}, "use_smote": False, "folds": 3}
    several = plan.train_and_evaluate(data, **options)
    assert (3, 3) in asked and asked.count((2, 2)) >= 2     # three folds; two searches; the two last fits of a model
    one = plan.train_and_evaluate(data, **options, parallelism=1)
    assert [(r.name, r.params, r.metrics) for r in several[0]] == [(r.name, r.params, r.metrics) for r in one[0]]
    assert sorted(map(tuple, several[1].collect())) == sorted(map(tuple, one[1].collect()))


def test_a_run_searches_neighbours_once_and_fits_in_turn(data, spark, monkeypatch):
    """Many rows: one neighbour search for all samples; searches run side by side and share the allowed fits."""
    import threading
    import time

    import churnlake.ml.smote as smote

    searches, running, most, lock = [], set(), [], threading.Lock()
    search, fit = smote.nearest_vectors, T.fit

    def counted(rows, name, *a, **b):
        me = (name, threading.get_ident())
        with lock:
            running.add(me)
            most.append((len(running), len({n for n, _ in running})))
        time.sleep(0.2)
        try:
            return fit(rows, name, *a, **b)
        finally:
            with lock:
                running.remove(me)

    monkeypatch.setattr(T, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(smote, "nearest_vectors", lambda *a, **b: searches.append(1) or search(*a, **b))
    monkeypatch.setattr(T, "fit", counted)
    options = {"grids": {"Logistic Regression": {"C": [1.0]}, "Random Forest": {"n_estimators": [2], "max_depth": [2]}},
               "draws": {"Logistic Regression": 1, "Random Forest": 1}, "folds": 2}
    several = plan.train_and_evaluate(data, **options, parallelism=2)
    assert len(searches) == 1 and len(most) == 8
    assert max(n for n, _ in most) == 2 and max(m for _, m in most) == 2
    monkeypatch.setattr(plan, "shared_neighbours", lambda train: None)      # a search for each sample
    monkeypatch.setattr(T, "shared_neighbours", lambda train: None)
    one = plan.train_and_evaluate(data, **options, parallelism=1)
    assert len(searches) == 1 + 4
    assert [(r.name, r.params) for r in several[0]] == [(r.name, r.params) for r in one[0]]
    for a, b in zip(several[0], one[0]):
        assert a.metrics == pytest.approx(b.metrics, abs=1e-9)
