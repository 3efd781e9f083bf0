"""Threshold sweep, metrics and curves. Every result comes from counts per score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import values as V
from churnlake.operators.ordering import By, ROWS_PER_BUCKET, quantiles, running_totals
from churnlake.session import stage

MODEL_THRESHOLDS = (20, 95)       # fixed values: percent, both ends included
ENSEMBLE_THRESHOLDS = (20, 80)


def count_where(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("long")


def percent_bin(score: Column) -> Column:
    """Largest whole percent p with ``score >= p / 100``, exact for binary doubles."""
    low = F.floor(score * 100).cast("int")
    return (F.when((low + 1) / F.lit(100.0) <= score, low + 1)
            .when(low / F.lit(100.0) > score, low - 1).otherwise(low))


def threshold_sweep(scored: DataFrame, limits: tuple[int, int] = MODEL_THRESHOLDS, score: str = "score",
                    label: str = "label") -> DataFrame:
    """Accuracy at every whole percent. One aggregation into at most 102 bins."""
    bins = scored.groupBy(percent_bin(F.col(score)).alias("bin")).agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg"))
    percent = F.explode(F.sequence(F.lit(limits[0]), F.lit(limits[1]))).alias("percent")
    hit = F.col("bin") >= F.col("percent")
    correct = F.sum(F.when(hit, F.col("pos")).otherwise(F.col("neg"))).cast("long")
    table = bins.select("bin", "pos", "neg", percent).groupBy("percent").agg(
        correct.alias("correct"), F.sum(F.col("pos") + F.col("neg")).cast("long").alias("total"))
    return table.select((F.col("percent") / F.lit(100.0)).alias("threshold"),
                        V.ratio(F.col("correct"), F.col("total")).alias("accuracy"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """First threshold with the highest accuracy."""
    return sweep.orderBy(F.col("accuracy").desc(), "threshold").limit(1)


def score_counts(scored: DataFrame, score: str = "score", label: str = "label", group: str | None = None) -> DataFrame:
    return scored.groupBy(*([group] if group else []), F.col(score).alias("score")).agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg"))


def cumulative_counts(scored: DataFrame, score: str = "score", label: str = "label",
                      rows_per_bucket: int = ROWS_PER_BUCKET, group: str | None = None) -> DataFrame:
    """True and false positives at every distinct score as threshold, highest first, in all or per ``group``.

    The counts per score are stored before they are ranged, so the scores are computed once.
    """
    counts = stage(score_counts(scored, score, label, group), "score-counts")
    return running_totals(counts, By("score", descending=True), {"tp": "pos", "fp": "neg"}, rows_per_bucket, group)


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label",
              rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    curve = cumulative_counts(scored, score, label, rows_per_bucket)
    totals = curve.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return curve.select(F.col("score").alias("threshold"),
                        V.ratio(F.col("fp"), F.lit(totals["n"])).alias("fpr"),
                        V.ratio(F.col("tp"), F.lit(totals["p"])).alias("tpr"))


def precision_recall_curve(scored: DataFrame, score: str = "score", label: str = "label",
                           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    curve = cumulative_counts(scored, score, label, rows_per_bucket)
    positives = curve.agg(F.sum("pos").alias("p")).first()["p"]
    return curve.select(F.col("score").alias("threshold"),
                        V.ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        V.ratio(F.col("tp"), F.lit(positives)).alias("recall"))


def auc(scored: DataFrame, score: str = "score", label: str = "label",
        rows_per_bucket: int = ROWS_PER_BUCKET, group: str | None = None) -> DataFrame:
    """Trapezoid area under the ROC curve, tied scores taken together; one row, or one per ``group``.

    Twice the area times P times N is a whole number, summed as a decimal.
    """
    curve = cumulative_counts(scored, score, label, rows_per_bucket, group)
    doubled = F.sum(F.col("neg").cast("decimal(19,0)") * (F.col("tp") * 2 - F.col("pos")).cast("decimal(19,0)"))
    keys = [group] if group else []
    area = curve.groupBy(*keys).agg(doubled.alias("a"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    bottom = F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")
    return area.select(*keys, V.ratio(F.col("a"), bottom).alias("roc_auc"))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1 to tp/fp/tn/fn; no division by zero."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return counts.withColumns({
        "accuracy": zero(V.ratio(tp + tn, tp + fp + tn + fn)),
        "precision": zero(V.ratio(tp, tp + fp)),
        "recall": zero(V.ratio(tp, tp + fn)),
        "f1_score": zero(V.ratio(tp * 2, tp * 2 + fp + fn)),
    })


def outcome_counts(threshold: Column | float, score: str = "score", label: str = "label") -> list[Column]:
    hit, yes, no = F.col(score) >= threshold, F.col(label) == 1, F.col(label) == 0
    return [count_where(hit & yes).alias("tp"), count_where(hit & no).alias("fp"),
            count_where(~hit & no).alias("tn"), count_where(~hit & yes).alias("fn")]


def binary_metrics(scored: DataFrame, threshold: float, score: str = "score", label: str = "label",
                   group: str | None = None) -> DataFrame:
    """Counts and metrics at a threshold: one row, or one per ``group``."""
    return metrics_from_counts(scored.groupBy(*([group] if group else [])).agg(*outcome_counts(threshold, score, label)))


def score_and_segment(scored: DataFrame, threshold: float, key: str = "customer_id", score: str = "score",
                      label: str = "label") -> DataFrame:
    """Prediction rows: label at the threshold, and a segment by percentile of the score.

    Segments use the unrounded score; the rounded one is for display.
    """
    p85, p70, p50 = quantiles(scored, score, [0.85, 0.70, 0.50])
    s = F.col(score)
    names = lambda c: F.when(c == 1, "Churn").when(c == 0, "No Churn")
    rows = scored.select(
        key, F.col(label).alias("Actual"), V.flag(s >= threshold).alias("Predicted"),
        V.half_up(s, 4).alias("Churn_Probability"),
        F.when(s >= F.lit(p85), "High Risk").when(s >= F.lit(p70), "Med-High Risk")
        .when(s >= F.lit(p50), "Med-Low Risk").otherwise("Low Risk").alias("Risk_Segment"))
    return rows.withColumns({
        "Actual_Label": names(F.col("Actual")), "Predicted_Label": names(F.col("Predicted")),
        "Correct": F.col("Actual") == F.col("Predicted")})
