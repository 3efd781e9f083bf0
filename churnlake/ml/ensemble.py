"""Soft voting and model choice from a history of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: export preference, best explained models first.
EXPORT_PRIORITY = ("XGBoost", "LightGBM", "Gradient Boosting", "Random Forest")
TOLERANCE = 0.03                 # fixed values: accuracy margin and targets
TARGET_ACCURACY = 0.82
TARGET_AUC = 0.85


def choose_members(validation_accuracy: dict[str, float], size: int = 3) -> list[str]:
    """Best models by validation accuracy; ties keep training order."""
    return sorted(validation_accuracy, key=lambda m: -validation_accuracy[m])[:size]


def soft_vote(scored: DataFrame, columns: dict[str, str], auc: dict[str, float], name: str = "ensemble") -> DataFrame:
    """Weighted mean of the members' scores, weights in proportion to their AUC."""
    total = 0.0
    for m in columns:
        total = total + auc[m]
    mean = None
    for m, c in columns.items():
        part = F.lit(auc[m] / total) * F.col(c)
        mean = part if mean is None else mean + part
    return scored.withColumn(name, mean)


def select_export_model(history: DataFrame, priority: tuple[str, ...] = EXPORT_PRIORITY,
                        tolerance: float = TOLERANCE) -> DataFrame:
    """One row per run: the first preferred model near the run's best, else the best."""
    everything = F.struct(*history.columns)
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("model_name"))
    best = history.groupBy("run_id").agg(F.max("accuracy").alias("best_accuracy"))
    near = history.join(best, "run_id").filter((rank > 0) & (F.col("accuracy") >= F.col("best_accuracy") - tolerance))
    preferred = near.groupBy("run_id").agg(F.min_by(everything, rank).alias("preferred"))
    order = F.struct((-F.col("accuracy")).alias("a"), (-F.col("roc_auc")).alias("r"), F.col("model_name"))
    top = history.groupBy("run_id").agg(F.min_by(everything, order).alias("top"))
    chosen = top.join(preferred, "run_id", "left").select(F.coalesce("preferred", "top").alias("m"))
    return chosen.select("m.*")


def target_gate(exported: DataFrame, accuracy: float = TARGET_ACCURACY, auc: float = TARGET_AUC) -> DataFrame:
    """Report, per run, whether the exported model meets the targets."""
    return exported.withColumn("target_met", (F.col("accuracy") >= accuracy) & (F.col("roc_auc") > auc))
