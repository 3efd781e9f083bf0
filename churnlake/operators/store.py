"""Feature store, prediction history, leaderboard and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def to_feature_rows(wide: DataFrame, features: list[str], computed_at: Column,
                    expires_at: Column | None = None, key: str = "customer_id") -> DataFrame:
    """Wide features to one row per customer and feature."""
    numbers = wide.select(key, *[F.col(f).cast("decimal(12,4)").alias(f) for f in features])
    return numbers.unpivot([key], features, "feature_name", "feature_value").select(
        key, "feature_name", "feature_value", F.lit("numeric").alias("feature_type"),
        computed_at.alias("computed_at"),
        (F.lit(None).cast("timestamp_ntz") if expires_at is None else expires_at).alias("expires_at"))


def write_feature_rows(rows: DataFrame, path: str) -> None:
    """Append, partitioned by day, so that reads as of a date skip later folders."""
    rows.withColumn("computed_on", F.to_date("computed_at")).write.mode("append").partitionBy(
        "computed_on").parquet(path)


def latest_features(store: DataFrame, as_of: Column, key: str = "customer_id") -> DataFrame:
    """Newest unexpired value per customer and feature at ``as_of``; of a store by day, later folders are not read.

    ``max_by`` combines on the map side, whatever the number of versions.
    """
    if "computed_on" in store.columns:
        store = store.filter(F.col("computed_on") <= F.to_date(as_of))
    valid = store.filter((F.col("computed_at") <= as_of) & (F.col("expires_at").isNull() | (F.col("expires_at") > as_of)))
    newest = F.max_by(F.struct("feature_value", "feature_type", "computed_at"), "computed_at")
    return valid.groupBy(key, "feature_name").agg(newest.alias("n")).select(key, "feature_name", "n.*")


def to_wide_features(rows: DataFrame, features: list[str], key: str = "customer_id") -> DataFrame:
    return rows.groupBy(key).pivot("feature_name", features).agg(F.max("feature_value"))


def latest_predictions(history: DataFrame) -> DataFrame:
    """Last prediction per customer and model; the higher id wins a tie on the date."""
    rest = [c for c in history.columns if c not in ("customer_id", "model_name")]
    last = history.groupBy("customer_id", "model_name").agg(
        F.max_by(F.struct(*rest), F.struct("prediction_date", "prediction_id")).alias("last"))
    return last.select("customer_id", "model_name", "last.*").select(*history.columns)


def top_risk_customers(predictions: DataFrame, k: int = 100) -> DataFrame:
    """The k customers with the highest probability (the report's own limit)."""
    return predictions.orderBy(F.col("churn_probability").desc_nulls_last(), "customer_id").limit(k)


def model_leaderboard(history: DataFrame) -> DataFrame:
    """Models of each run by accuracy, then ROC-AUC, both descending."""
    order = Window.partitionBy("run_id").orderBy(
        F.col("accuracy").desc_nulls_last(), F.col("roc_auc").desc_nulls_last(), "model_name")
    return history.withColumn("leaderboard_rank", F.row_number().over(order))


def latest_model_versions(history: DataFrame) -> DataFrame:
    """Newest training per model and version."""
    rest = [c for c in history.columns if c not in ("model_name", "model_version")]
    last = history.groupBy("model_name", "model_version").agg(
        F.max_by(F.struct(*rest), F.struct("training_date", "run_id")).alias("last"))
    return last.select("model_name", "model_version", "last.*").select(*history.columns)


def params_to_json(df: DataFrame, columns: list[str], name: str = "hyperparameters") -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct(*columns)))


def params_from_json(df: DataFrame, schema: str, column: str = "hyperparameters") -> DataFrame:
    parsed = df.withColumn("__params", F.from_json(column, schema))
    return parsed.select(*df.columns, "__params.*")


def upsert_customers(current: DataFrame, incoming: DataFrame, now: Column, key: str = "customer_id") -> DataFrame:
    """Insert new keys, update changed ones.

    ``created_at`` of a known key stays; ``updated_at`` moves only if a value changed.
    """
    values = [c for c in current.columns if c not in (key, "created_at", "updated_at")]
    old = current.select(key, F.struct(*values).alias("old"), "created_at", "updated_at")
    new = incoming.select(key, F.struct(*values).alias("new"))
    both = old.join(new, key, "full_outer")
    changed = F.col("new").isNotNull() & F.col("old").isNotNull() & ~F.col("new").eqNullSafe(F.col("old"))
    merged = F.coalesce("new", "old")
    return both.select(
        key, *[merged[c].alias(c) for c in values],
        F.coalesce("created_at", now).alias("created_at"),
        F.when(changed | F.col("old").isNull(), now).otherwise(F.col("updated_at")).alias("updated_at"))


def top_contributions(scored: DataFrame, contributions: dict[str, Column], k: int = 3) -> DataFrame:
    """The k features with the largest absolute contribution, per row and in row."""
    parts = F.array(*[F.struct(F.abs(v).alias("size"), F.lit(n).alias("feature"), v.alias("value"))
                      for n, v in contributions.items()])
    best = F.slice(F.sort_array(parts, asc=False), 1, k)
    out = scored.withColumn("__best", best)
    for i in range(k):
        out = out.withColumns({
            f"top_feature_{i + 1}": F.get("__best", F.lit(i))["feature"],
            f"top_feature_{i + 1}_importance": F.get("__best", F.lit(i))["value"]})
    return out.drop("__best")
