"""Registered queries: operator name to a function of (spark, folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import inputs as I
from checks import model_queries
from churnlake import schema
from churnlake.functions import values as V
from churnlake.ml import ensemble, evaluation, split
from churnlake.operators import cleaning, features, quality, reports, rfm, store
from churnlake.plans import customers as plans
from churnlake.session import new_path, stage
from churnlake.sources import files, tables, telco

AS_OF = "2024-06-01"


def _renamed(s, d):
    return cleaning.rename_columns(telco.raw_feed(s, d))


def _tiles(df):
    return rfm.rfm_tiles(rfm.rfm_base(df))


# -- cleaning ---------------------------------------------------------------

def clean_rename(s, d):
    return _renamed(s, d)


def clean_total_charges(s, d):
    return cleaning.clean_total_charges(_renamed(s, d)).select("ingest_seq", "customer_id", "total_charges")


def impute_total_charges(s, d):
    return cleaning.impute_total_charges(_renamed(s, d)).select("ingest_seq", "customer_id", "total_charges")


def clean_yes_no(s, d):
    return cleaning.clean_yes_no(_renamed(s, d)).select("ingest_seq", *cleaning.YES_NO_COLUMNS)


def clean_int(s, d):
    return cleaning.clean_int(_renamed(s, d)).select("ingest_seq", "senior_citizen")


def clip_negative(s, d):
    df = cleaning.clean_total_charges(_renamed(s, d))
    return cleaning.clip_negative(df).select("ingest_seq", *cleaning.AMOUNT_COLUMNS)


def dedupe_customers(s, d):
    return cleaning.dedupe_customers(_renamed(s, d)).select("customer_id", "ingest_seq", "payment_method")


def tenure_group(s, d):
    return cleaning.add_tenure_group(_renamed(s, d)).select(
        "ingest_seq", "tenure_group", V.tenure_bucket(F.col("tenure")).alias("tenure_bucket"))


def clean_customers(s, d):
    return I.customers(s, d)


def filter_churned(s, d):
    return cleaning.filter_segment(I.segmented_customers(s, d), "churned").select("customer_id", "monthly_charges", "tenure")


def filter_high_value(s, d):
    return cleaning.filter_segment(I.segmented_customers(s, d), "high_value").select("customer_id", "churn", "contract")


def filter_long_tenure(s, d):
    return cleaning.filter_segment(I.segmented_customers(s, d), "long_tenure").select("customer_id", "churn", "monthly_charges")


def filter_unexpired(s, d):
    return cleaning.unexpired(I.feature_history(s, d), I.ntz(AS_OF))


def payment_text_search(s, d):
    return cleaning.payment_text_search(I.customers(s, d), ["Automatic", "bank"]).select("customer_id", "payment_method")


def customer_summary(s, d):
    return cleaning.customer_summary(I.customers(s, d))


# -- features ---------------------------------------------------------------

def billing_features(s, d):
    return features.billing_features(I.customers(s, d)).select(
        "customer_id", "avg_monthly_spend", "is_new_customer", "tenure_charge_ratio", "charge_per_tenure_plus1",
        "service_intensity", "senior_and_new", "electronic_check_flag", "auto_pay_flag", "partner_dependents_flag",
        "multi_services")


def customer_features(s, d):
    df = features.customer_features(I.stored_customers(s, d))
    return df.select("customer_id", "tenure_group", "churned", *features.NUMERIC_FEATURES)


def service_counts(s, d):
    return features.service_counts(I.customers(s, d))


# -- windows and scoring ------------------------------------------------------

def ntile_global(s, d):
    return _tiles(I.stored_customers(s, d)).select("customer_id", "recency_ntile", "frequency_ntile", "monetary_ntile")


def cohort_benchmarks(s, d):
    df = features.billing_features(I.stored_customers(s, d)).withColumn("tenure_group", V.tenure_group(F.col("tenure")))
    return rfm.cohort_benchmarks(df).select(
        "customer_id", "avg_totalcharges_by_contract", "avg_services_by_contract", "avg_monthly_by_tenure_group",
        V.half_up(F.col("avg_tenure_charge_ratio_by_group"), 6).alias("avg_tenure_charge_ratio_by_group"))


def lag_in_cohort(s, d):
    return rfm.lag_in_cohort(I.stored_customers(s, d), {
        "prev_total": "total_charges", "prev_monthly": "monthly_charges"}).select("customer_id", "prev_total", "prev_monthly")


def rfm_base(s, d):
    return rfm.rfm_base(I.customers(s, d)).select("customer_id", "recency_months", "frequency_txn", "monetary_value")


def rfm_score(s, d):
    return rfm.rfm_score(_tiles(I.stored_customers(s, d))).select("customer_id", "rfm_score")


def risk_segment(s, d):
    df = rfm.rfm_score(_tiles(I.stored_customers(s, d)))
    return rfm.add_risk_segment(df, ("High Risk", "Medium Risk", "Low Risk")).select("customer_id", "risk_segment")


def enhanced_risk_segment(s, d):
    df = rfm.rfm_score(_tiles(features.billing_features(I.stored_customers(s, d))))
    return rfm.add_enhanced_risk_segment(df).select("customer_id", "enhanced_risk_segment")


def rfm_features(s, d):
    return plans.rfm_features(I.stored_customers(s, d))


def enhanced_features(s, d):
    df = plans.enhanced_features(I.stored_customers(s, d), computed_at=I.ntz(AS_OF))
    return df.withColumn("avg_tenure_charge_ratio_by_group", V.half_up(F.col("avg_tenure_charge_ratio_by_group"), 6))


def rfm_from_orders(s, d):
    orders = telco.read_table(s, d, "orders")
    return rfm.rfm_from_transactions(
        orders, "o_custkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long"))


def rfm_from_events(s, d):
    events = telco.read_table(s, d, "events")
    return rfm.rfm_from_transactions(events, "user_id", "ts", F.round(F.col("value") * 100).cast("long"))


# -- reports ------------------------------------------------------------------

def churn_distribution(s, d):
    return reports.churn_distribution(I.customers(s, d))


def churn_rate_by_contract(s, d):
    return reports.churn_rate_by_contract(I.customers(s, d))


def pivot_churn_by_contract(s, d):
    return reports.churn_by_contract_pivot(I.customers(s, d))


def cohort_churn_analysis(s, d):
    return reports.cohort_churn_analysis(I.customers(s, d))


def risk_scorecard(s, d):
    return reports.risk_scorecard(evaluation.score_and_segment(stage(I.scored(s, d)), 0.5))


def confusion_matrix(s, d):
    return reports.confusion_matrix(I.scored(s, d), 0.48)


def roi_calculator(s, d):
    return reports.roi_calculator(stage(I.scored(s, d)))


def correlation_matrix(s, d):
    df = reports.correlation_matrix(I.customers(s, d))
    return df.withColumn("correlation", V.half_up(F.col("correlation"), 6))


def quantiles(s, d):
    return reports.quantile_table(I.customers(s, d), "monthly_charges", [0.25, 0.5, 0.7, 0.75, 0.85])


def boxplot_stats(s, d):
    return reports.boxplot_stats(I.stored_customers(s, d))


def numeric_summary(s, d):
    return reports.numeric_summary(I.stored_customers(s, d))


def churn_analytics(s, d):
    df = rfm.rfm_score(_tiles(I.stored_customers(s, d)))
    df = rfm.add_risk_segment(df, ("High Risk", "Medium Risk", "Low Risk")).withColumn(
        "tenure_group", V.tenure_group(F.col("tenure")))
    return reports.churn_analytics(
        df.withColumn("risk_segment_value", F.col("risk_segment")), F.lit("2024-06-01").cast("date"))


# -- quality ------------------------------------------------------------------

def dq_null_counts(s, d):
    return quality.null_counts(I.customers(s, d))


def dq_duplicates(s, d):
    return quality.duplicates(_renamed(s, d))


def dq_outliers_iqr(s, d):
    return quality.outliers_iqr(I.stored_customers(s, d))


def dq_zero_tenure_charged(s, d):
    return quality.business_checks(I.customers(s, d)).select("zero_tenure_charged")


def dq_billing_discrepancy(s, d):
    return quality.business_checks(I.customers(s, d)).select("billing_discrepancy")


def dq_report(s, d):
    return quality.quality_report(I.stored_customers(s, d), checked_at=I.ntz(AS_OF))


def dq_constraints(s, d):
    raw = cleaning.clean_total_charges(_renamed(s, d))
    on_customers = quality.constraint_violations(raw, quality.customer_rules(), "customers")
    on_predictions = quality.constraint_violations(
        I.prediction_history(s, d), quality.prediction_rules(), "predictions")
    return on_customers.unionByName(on_predictions)


def dq_primary_key(s, d):
    return quality.primary_key_violations(_renamed(s, d), ["customer_id"])


def _kept(s, d):
    return I.customers(s, d).filter(F.col("churn") == "No")


def dq_foreign_key(s, d):
    return quality.foreign_key_orphans(I.feature_history(s, d), _kept(s, d))


def cascade_delete(s, d):
    return quality.cascade_delete(I.feature_history(s, d), _kept(s, d))


# -- feature store, predictions, leaderboard ------------------------------------

def feature_store_write(s, d):
    df = I.customers(s, d)
    return store.to_feature_rows(df, I.FEATURES_STORED, I.ntz("2024-01-01"), I.ntz("2024-03-01"))


def feature_store_latest(s, d):
    return store.latest_features(I.feature_history(s, d), I.ntz(AS_OF))


def feature_store_wide(s, d):
    return store.to_wide_features(store.latest_features(I.feature_history(s, d), I.ntz(AS_OF)), I.FEATURES_STORED)


def predictions_latest(s, d):
    return store.latest_predictions(I.prediction_history(s, d))


def top_risk_customers(s, d):
    df = store.latest_predictions(I.prediction_history(s, d)).filter(F.col("model_name") == "XGBoost")
    return store.top_risk_customers(df, 50).select("customer_id", "churn_probability")


def model_leaderboard(s, d):
    return store.model_leaderboard(I.performance_history(s, d)).select(
        "run_id", "model_name", "accuracy", "roc_auc", "leaderboard_rank")


def model_latest_version(s, d):
    return store.latest_model_versions(I.performance_history(s, d)).select(
        "model_name", "model_version", "run_id", "accuracy")


def hyperparameters_json(s, d):
    df = I.performance_history(s, d).select(
        "run_id", "model_name", F.col("test_size").alias("n_estimators"), F.col("model_version").alias("solver"))
    df = store.params_to_json(df, ["n_estimators", "solver"]).select("run_id", "model_name", "hyperparameters")
    return store.params_from_json(df, "n_estimators bigint, solver string")


def upsert_customers(s, d):
    base = _renamed(s, d)
    first = cleaning.dedupe_customers(base).select(
        "customer_id", "contract", "payment_method", I.ntz("2024-01-01").alias("created_at"),
        I.ntz("2024-01-01").alias("updated_at")).filter(F.col("contract").isNotNull())
    last = cleaning.dedupe_customers(base.withColumn("back", -F.col("ingest_seq")), order="back")
    incoming = last.filter(F.col("tenure").isNotNull()).select("customer_id", "contract", "payment_method")
    return store.upsert_customers(first, incoming, I.ntz("2024-02-01"))


# -- evaluation on given scores -------------------------------------------------

def stratified_split(s, d):
    df = I.stored_customers(s, d).select("customer_id", "churn")
    return split.stratified_split(df, "churn")


def stratified_folds(s, d):
    df = I.stored_customers(s, d).select("customer_id", "churn")
    return split.stratified_folds(df, "churn")


def threshold_sweep(s, d):
    return evaluation.threshold_sweep(I.scored(s, d))


def best_threshold(s, d):
    return evaluation.best_threshold(evaluation.threshold_sweep(I.scored(s, d)))


def binary_metrics(s, d):
    return evaluation.binary_metrics(I.scored(s, d), 0.48)


def roc_curve(s, d):
    return evaluation.roc_curve(stage(I.scored(s, d).select("score", "label")))


def auc(s, d):
    return evaluation.auc(stage(I.scored(s, d).select("score", "label")))


def precision_recall_curve(s, d):
    return evaluation.precision_recall_curve(stage(I.scored(s, d).select("score", "label")))


def soft_vote(s, d):
    df = stage(I.scored(s, d).select("customer_id", "label", *I.SCORE_COLUMNS.values()))
    accuracy = {m: evaluation.best_threshold(evaluation.threshold_sweep(df, score=c)).first()["accuracy"]
                for m, c in I.SCORE_COLUMNS.items()}
    members = ensemble.choose_members(accuracy)
    areas = {m: evaluation.auc(df, I.SCORE_COLUMNS[m]).first()["roc_auc"] for m in members}
    voted = ensemble.soft_vote(df, {m: I.SCORE_COLUMNS[m] for m in members}, areas)
    return voted.select("customer_id", V.half_up(F.col("ensemble"), 6).alias("ensemble"))


def select_export_model(s, d):
    return ensemble.select_export_model(I.performance_history(s, d)).select("run_id", "model_name", "accuracy", "roc_auc")


def target_gate(s, d):
    df = ensemble.target_gate(ensemble.select_export_model(I.performance_history(s, d)))
    return df.select("run_id", "model_name", "target_met")


def score_and_segment(s, d):
    return evaluation.score_and_segment(stage(I.scored(s, d)), 0.48)


def run_sql(s, d):
    return tables.run_sql(s, """
        SELECT contract, COUNT(*) AS customers, CAST(SUM(monthly_charges) AS DOUBLE) AS revenue
        FROM {customers} WHERE tenure >= :least_tenure GROUP BY contract""",
        {"customers": I.customers(s, d)}, least_tenure=12)


def _raw_csv(s, d):
    path = new_path(s, "raw-csv")
    files.export_csv(telco.raw_feed(s, d).select(*schema.RAW_COLUMNS), path)
    return path


def load_customers(s, d):
    df = cleaning.clean_total_charges(cleaning.rename_columns(files.load_customers(s, _raw_csv(s, d))))
    return df.select("customer_id", "tenure", "contract", "monthly_charges", "total_charges", "churn")


def load_or_fallback(s, d):
    """No such table here, so the file is read."""
    df = tables.load_or_fallback(s, f"absent_{uuid.uuid4().hex}", _raw_csv(s, d))
    return df.groupBy(F.col("Contract").alias("contract")).agg(F.count(F.lit(1)).alias("customers"))


def write_table(s, d):
    """Written twice, the second time appended."""
    name, path = f"customers_{uuid.uuid4().hex}", new_path(s, "table")
    df = I.stored_customers(s, d)
    tables.write_table(df, name, "fail", path)
    tables.write_table(df, name, "append", path)
    return s.table(name).groupBy("churn").agg(F.count(F.lit(1)).alias("row_count"))


def reload_table(s, d):
    """Loaded twice: the second load takes the place of the first."""
    path = new_path(s, "reloaded")
    df = I.stored_customers(s, d).select("customer_id", "contract", "churn")
    tables.reload_table(df, path)
    return tables.reload_table(df, path)


def export_csv(s, d):
    path = new_path(s, "csv")
    files.export_csv(reports.cohort_churn_analysis(I.customers(s, d)), path, single_file=True)
    return s.read.option("header", True).csv(path).select(
        "tenure_group", F.col("Total_Customers").cast("long").alias("total_customers"),
        F.col("Churned").cast("long").alias("churned"))


_NAMES = [
    load_customers, load_or_fallback, write_table, reload_table, export_csv,
    clean_rename, clean_total_charges, impute_total_charges, clean_yes_no, clean_int, clip_negative,
    dedupe_customers, tenure_group, clean_customers, filter_churned, filter_high_value, filter_long_tenure,
    filter_unexpired, payment_text_search, customer_summary, billing_features, customer_features, service_counts,
    ntile_global, cohort_benchmarks, lag_in_cohort, rfm_base, rfm_score, risk_segment, enhanced_risk_segment,
    rfm_features, enhanced_features, rfm_from_orders, rfm_from_events, churn_distribution, churn_rate_by_contract,
    pivot_churn_by_contract, cohort_churn_analysis, risk_scorecard, confusion_matrix, roi_calculator,
    correlation_matrix, quantiles, boxplot_stats, numeric_summary, churn_analytics, dq_null_counts, dq_duplicates,
    dq_outliers_iqr, dq_zero_tenure_charged, dq_billing_discrepancy, dq_report, dq_constraints, dq_primary_key,
    dq_foreign_key, cascade_delete, feature_store_write, feature_store_latest, feature_store_wide,
    predictions_latest, top_risk_customers, model_leaderboard, model_latest_version, hyperparameters_json,
    upsert_customers, stratified_split, stratified_folds, threshold_sweep, best_threshold, binary_metrics,
    roc_curve, auc, precision_recall_curve, soft_vote, select_export_model, target_gate, score_and_segment, run_sql,
]


def registered():
    def finished(f):
        return lambda spark, folder: I.plain(f(spark, folder))

    return {f.__name__: finished(f) for f in _NAMES + model_queries.NAMES}
