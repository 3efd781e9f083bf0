"""Input frames of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions import values as V
from churnlake.operators import store
from churnlake.operators.cleaning import clean_customers, store_segments
from churnlake.session import new_path, stage
from churnlake.sources.telco import raw_feed

# Rule scores in basis points, as SQL that both engines run. They stand for model output.
SCORE_SQL = {
    "Logistic Regression": "CAST(FLOOR(6000.0 / (1 + COALESCE(tenure, 0))) AS BIGINT)"
                           " + CASE WHEN contract = 'Month-to-month' THEN 3000 WHEN contract = 'One year' THEN 1000 ELSE 200 END",
    "Random Forest": "500 + CASE WHEN payment_method = 'Electronic check' THEN 1500 ELSE 0 END"
                     " + CASE WHEN tenure <= 12 THEN 4500 ELSE 0 END"
                     " + CASE WHEN internet_service = 'Fiber optic' THEN 1500 ELSE 0 END"
                     " + CASE WHEN monthly_charges > 60 THEN 1000 ELSE 0 END",
    "Gradient Boosting": "300 + 120 * (78 - COALESCE(tenure, 0))",
    "XGBoost": "CAST(FLOOR(5000.0 / (1 + COALESCE(tenure, 0))) AS BIGINT)"
               " + CAST(FLOOR(monthly_charges * 10) AS BIGINT) + CASE WHEN contract = 'Two year' THEN 0 ELSE 800 END",
    "LightGBM": "CASE WHEN tenure <= 3 THEN 7000 WHEN tenure <= 24 THEN 3000 ELSE 1000 END"
                " + CASE WHEN partner = 'Yes' THEN 0 ELSE 400 END",
}
SCORE_COLUMNS = {m: "score_" + m.lower().replace(" ", "_") for m in SCORE_SQL}
FEATURES_STORED = ["tenure", "monthly_charges", "total_charges", "senior_citizen"]


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return clean_customers(raw_feed(spark, folder))


def stored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customers table written once, for plans that read it several times."""
    return stage(customers(spark, folder), "customers")


def segmented_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customers table in the layout that segment filters read."""
    return store_segments(customers(spark, folder), new_path(spark, "segments"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    df = customers(spark, folder).withColumn("label", V.flag(F.col("churn") == "Yes"))
    for model, name in SCORE_COLUMNS.items():
        points = F.expr(SCORE_SQL[model]).cast("long")
        df = df.withColumn(name, F.least(points, F.lit(9999)).cast("double") / 10000.0)
    return df.withColumn("score", F.col("score_logistic_regression"))


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def feature_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three computations of four features: expired, current, and one in the future."""
    df = customers(spark, folder).select("customer_id", "churn", *FEATURES_STORED)
    first = store.to_feature_rows(df, FEATURES_STORED, ntz("2024-01-01"), ntz("2024-03-01"))
    second = store.to_feature_rows(df.filter(F.col("churn") == "No"), FEATURES_STORED, ntz("2024-02-01"))
    third = store.to_feature_rows(df, FEATURES_STORED, ntz("2024-05-01"), ntz("2024-09-01"))
    later = store.to_feature_rows(df, FEATURES_STORED, ntz("2024-07-01"))
    return first.unionByName(second).unionByName(third).unionByName(later)


def prediction_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two dated predictions per customer and model; the first with half the score."""
    models = F.array(*[F.struct(
        F.lit(i).alias("no"), F.lit(m).alias("model_name"), F.col(c).alias("score"))
        for i, (m, c) in enumerate(SCORE_COLUMNS.items())])
    df = scored(spark, folder).select("customer_id", "ingest_seq", F.explode(models).alias("m"))
    df = df.select("customer_id", "ingest_seq", "m.*", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"))
    probability = F.when(F.col("turn") == 0, F.col("score") / 2).otherwise(F.col("score"))
    return df.select(
        (F.col("ingest_seq") * 10 + F.col("no") * 2 + F.col("turn")).alias("prediction_id"),
        "customer_id", "model_name", probability.alias("churn_probability"),
        V.flag(probability >= 0.5).alias("predicted_churn"),
        F.when(F.col("turn") == 0, ntz("2024-01-01")).otherwise(ntz("2024-02-01")).alias("prediction_date"))


def performance_history(spark: SparkSession, folder: str) -> DataFrame:
    """One run per region and model, measured at 0.5 on the region's customers."""
    from churnlake.ml import evaluation as E

    models = F.array(*[F.struct(F.lit(m).alias("model_name"), F.col(c).alias("score")) for m, c in SCORE_COLUMNS.items()])
    df = scored(spark, folder).select("region_no", "label", F.explode(models).alias("m"))
    counts = df.select("region_no", "label", "m.*").groupBy("region_no", "model_name").agg(
        *E.outcome_counts(0.5))
    sensitivity = F.coalesce(V.ratio(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    specificity = F.coalesce(V.ratio(F.col("tn"), F.col("tn") + F.col("fp")), F.lit(0.0))
    return E.metrics_from_counts(counts).select(
        F.concat(F.lit("run-"), F.col("region_no").cast("string")).alias("run_id"), "model_name",
        F.when(F.col("region_no") % 2 == 0, "v1").otherwise("v2").alias("model_version"),
        F.col("region_no").alias("training_date"),
        "accuracy", "precision", "recall", "f1_score", ((sensitivity + specificity) / 2).alias("roc_auc"),
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("test_size"))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, so that both engines hand out equal values."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)
