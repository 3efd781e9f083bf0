"""Registered queries that train models; small parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from churnlake.ml import encode, evaluation, smote as oversampling, split, training as T
from churnlake.operators import features, reports, store
from churnlake.plans import training as plan
from churnlake.session import new_path, stage

#: One point of each grid: the least number of trees that a grid has for gradient boosting, 100, for all.
POINTS = {
    "Logistic Regression": {"C": 1.0},
    "Random Forest": {"n_estimators": 100, "max_depth": 8, "max_features": "sqrt"},
    "Gradient Boosting": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1},
    "Weighted GBT": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "positive_weight": 2.6},
    "Column-Sampled GBT": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "column_share": 0.7},
}
#: Trees per boosted model where five models are trained seven times each.
FEW_TREES = 20


def one_hot(s, d):
    df = features.customer_features(I.stored_customers(s, d).drop("tenure_group"))
    marked = stage(split.stratified_split(df, "churn"), "split")
    columns = ["contract", "payment_method", "internet_service", "multiple_lines", "tenure_group"]
    coded = encode.one_hot(marked, encode.fit_categories(marked.filter("is_train"), columns))
    dummies = [c for c in coded.columns if c not in marked.columns]
    return coded.select("customer_id", "is_train", *dummies)


def one_hot_sparse(s, d):
    """Slots of three columns, one of them as wide as the table."""
    df, columns = I.stored_customers(s, d), ["contract", "payment_method", "customer_id"]
    slots, width = encode.category_slots(df, columns)
    return encode.one_hot_sparse(df, "customer_id", columns, slots).select(
        "customer_id", F.array_join("slots", ",").alias("slots"), F.lit(width).cast("long").alias("width"))


def _data(s, d):
    return plan.make_dataset(I.stored_customers(s, d))


def _trained(s, d, name):
    """Metrics on the test rows at 0.5, one row."""
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), name, POINTS[name])
    scored = stage(T.score(model, encode.with_vector(data.test)).select("customer_id", "label", "score"), "scored")
    area = evaluation.auc(scored).first()["roc_auc"]
    return evaluation.binary_metrics(scored, 0.5).withColumns({"model_name": F.lit(name), "roc_auc": F.lit(area)})


def smote(s, d):
    data = _data(s, d)
    return oversampling.balance(data.train).groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("rows"))


def train_logistic(s, d):
    return _trained(s, d, "Logistic Regression")


def train_random_forest(s, d):
    return _trained(s, d, "Random Forest")


def train_gbt(s, d):
    return _trained(s, d, "Gradient Boosting")


def train_gbt_weighted(s, d):
    return _trained(s, d, "Weighted GBT")


def train_gbt_column_sampled(s, d):
    return _trained(s, d, "Column-Sampled GBT")


def save_model(s, d):
    """Save a trained model with its numbers, load it, score the test rows with it."""
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), "Logistic Regression", POINTS["Logistic Regression"])
    path = new_path(s, "model")
    T.save_result(s, T.ModelResult("Logistic Regression", POINTS["Logistic Regression"], {"accuracy": 0.0}, model), path)
    loaded = T.load_result(s, path)
    return T.score(loaded.model, encode.with_vector(data.test)).select("customer_id", "label", "score")


def random_search(s, d):
    """All points of the logistic grid over five folds."""
    folded = stage(split.stratified_folds(_data(s, d).train, "label"), "folds")
    name = "Logistic Regression"
    found = T.random_search(folded, name, T.draw_parameters(T.GRIDS[name], T.DRAWS[name]), "roc_auc", False)
    rows = [(i + 1, p["C"], p["class_weight"], v) for i, (p, v) in enumerate(found)]
    return s.createDataFrame(rows, "rank int, c double, class_weight string, mean_roc_auc double")


def feature_importance(s, d):
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), "Random Forest", POINTS["Random Forest"])
    return s.createDataFrame(T.feature_importance(model, data.names), "feature string, importance double")


def permutation_importance(s, d):
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), "Logistic Regression", POINTS["Logistic Regression"])
    rows = T.permutation_importance(model, data.test, data.names)
    return s.createDataFrame(rows, "feature string, auc_loss double")


def top_features_per_prediction(s, d):
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), "Logistic Regression", POINTS["Logistic Regression"])
    scored = T.score(model, encode.with_vector(data.test))
    return store.top_contributions(scored, T.contributions(model, data.names)).select(
        "customer_id", "score", *[f"top_feature_{i}{e}" for i in (1, 2, 3) for e in ("", "_importance")])


def model_risk_scorecard(s, d):
    data = _data(s, d)
    model = T.fit(T.prepare(data.train, False), "Random Forest", POINTS["Random Forest"])
    scored = stage(T.score(model, encode.with_vector(data.test)).select("customer_id", "label", "score"), "scored")
    return reports.risk_scorecard(evaluation.score_and_segment(scored, 0.5))


def record_run(s, d):
    """A whole run: five models, five folds, oversampled, one point each; the history it wrote."""
    history = new_path(s, "runs")
    grids = {n: {k: [FEW_TREES if k == "n_estimators" else v] for k, v in p.items()} for n, p in POINTS.items()}
    plan.run(I.stored_customers(s, d), history, "check run", "2024-06-01 00:00:00", grids=grids, draws={n: 1 for n in grids})
    return s.read.parquet(history)


def model_checks(s, d):
    """All five models on the same rows: counts that add up, metrics that follow from them, a ranking better than chance."""
    data = _data(s, d)
    train = T.prepare(data.train, False)
    out = None
    for name, point in POINTS.items():
        model = T.fit(train, name, {k: FEW_TREES if k == "n_estimators" else v for k, v in point.items()})
        scored = plan.scores_of(model, data.test)
        m = plan.measured(scored, 0.5)
        one = scored.agg(
            F.lit(name).alias("model_name"), F.count(F.lit(1)).alias("test_rows"), F.sum("label").alias("test_churned"),
            (F.count_if((F.col("score") >= 0.5) == (F.col("label") == 1)) / F.count(F.lit(1)) == F.lit(m["accuracy"])).alias("accuracy_follows"),
            (F.count_if(~F.col("score").between(0, 1)) == 0).alias("scores_are_probabilities"),
            (F.lit(m["roc_auc"]) > 0.5).alias("better_than_chance"))
        out = one if out is None else out.unionByName(one)
    return out


def explanation_checks(s, d):
    """Per test row whether contributions and intercept give the log-odds of its score; importances of a forest add up to one."""
    data = _data(s, d)
    train = T.prepare(data.train, False)
    logistic, forest = (T.fit(train, n, POINTS[n]) for n in ("Logistic Regression", "Random Forest"))
    total = sum(v for _, v in T.feature_importance(forest, data.names, len(data.names)))
    scored = stage(T.score(logistic, encode.with_vector(data.test)).withColumn("odds", T.log_odds(logistic, data.names)), "explained")
    top = store.top_contributions(scored, T.contributions(logistic, data.names))
    sizes = [F.abs(F.col(f"top_feature_{i}_importance")) for i in (1, 2, 3)]
    return top.select(
        "customer_id", (F.abs(F.ln(F.col("score") / (1 - F.col("score"))) - F.col("odds")) < 1e-6).alias("adds_up"),
        ((sizes[0] >= sizes[1]) & (sizes[1] >= sizes[2])).alias("in_order"),
        F.lit(abs(total - 1) < 1e-9).alias("importances_add_up"))


def resumed_model(s, d):
    """Test rows scored by a checkpoint that a second run loaded, against the scores of the first."""
    data, folder, grid = _data(s, d), new_path(s, "checkpoints"), {"Logistic Regression": {"C": [1.0]}}
    runs = [plan.train_and_evaluate(data, grids=grid, draws={"Logistic Regression": 1}, use_smote=False, folds=2, checkpoints=folder)[1]
            for _ in range(2)]
    first, second = (r.select("customer_id", "label", F.col("score_logistic_regression").alias(f"score_{i}")) for i, r in enumerate(runs))
    return first.join(second, ["customer_id", "label"]).select("customer_id", "label", (F.col("score_0") == F.col("score_1")).alias("same_score"))


def smote_uses(s, d):
    """How often the synthetic rows use each minority customer, and whether they stay within the minority's ranges."""
    data = _data(s, d)
    made = oversampling.smote(data.train).withColumn("base", F.element_at(F.split("customer_id", "-"), -2))
    few = data.train.filter("label = 1").select("x")
    low, high = ([F.min(F.get("x", F.lit(i))) for i in range(len(data.names))], [F.max(F.get("x", F.lit(i))) for i in range(len(data.names))])
    limits = few.agg(F.array(*low).alias("low"), F.array(*high).alias("high")).first()
    inside = F.forall(F.zip_with(F.zip_with("x", F.array(*[F.lit(v) for v in limits["low"]]), lambda v, a: v >= a - 1e-9),
                                 F.zip_with("x", F.array(*[F.lit(v) for v in limits["high"]]), lambda v, b: v <= b + 1e-9),
                                 lambda a, b: a & b), lambda ok: ok)
    return made.groupBy("base").agg(F.count(F.lit(1)).alias("n"), F.bool_and(inside).alias("ok")).groupBy(F.col("n").alias("uses")).agg(
        F.count(F.lit(1)).alias("customers"), F.bool_and("ok").alias("within_ranges"))


def run_history(s, d):
    """Runs recorded from given scores, one of them twice: the leaderboard and versions of what the history then holds."""
    path, given = new_path(s, "history"), I.performance_history(s, d).collect()
    for run in sorted({r["run_id"] for r in given}):
        for accuracy in ((0.0, None) if run == "run-1" else (None,)):    # the first record of this run is replaced
            results = [T.ModelResult(r["model_name"], {}, r.asDict() | ({} if accuracy is None else {"accuracy": accuracy}))
                       for r in given if r["run_id"] == run]
            T.record_run(s, path, {"run_id": run, "metric": "accuracy", "use_smote": False, "seed": 42,
                                   "created_at": f"2024-06-{int(run[4:]) + 1:02} 00:00:00"}, results)
    board = store.model_leaderboard(s.read.parquet(path)).select("run_id", "model_name", "accuracy", "leaderboard_rank", "test_size")
    versions = store.latest_model_versions(s.read.parquet(path)).select("run_id", "model_name", "model_version")
    return board.join(versions, ["run_id", "model_name"])


NAMES = [one_hot, one_hot_sparse, smote, smote_uses, save_model, train_logistic, train_random_forest, train_gbt, train_gbt_weighted,
         train_gbt_column_sampled, random_search, feature_importance, permutation_importance,
         top_features_per_prediction, model_risk_scorecard, record_run, model_checks, explanation_checks, resumed_model, run_history]
