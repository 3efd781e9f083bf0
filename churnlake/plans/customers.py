"""Whole feature queries.

``customers`` should be a stored table: the plans read it in several narrow passes (row
count, tile ends, cohort means) before the one pass that produces the rows. Steps that
need no row shuffle come first, the lag - the only one that moves rows - comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import values as V
from churnlake.operators import features, rfm
from churnlake.operators.ordering import ROWS_PER_BUCKET


def rfm_features(customers: DataFrame, ordered: bool = True, monetary_descending: bool = True,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Cohort and RFM features, 16 columns. ``ordered=False`` spares the final sort."""
    rows = customers.count()
    df = rfm.rfm_base(customers.select(
        "customer_id", "tenure", "monthly_charges", "total_charges", "contract", "churn",
        V.tenure_group(F.col("tenure")).alias("tenure_group")))
    df = rfm.rfm_score(rfm.rfm_tiles(df, monetary_descending, rows_per_bucket, rows))
    df = rfm.add_risk_segment(df, ("High Risk", "Med Risk", "Low Risk"))
    df = rfm.group_means(df, "contract", {"avg_totalcharges_by_contract": V.mean_of("monetary_value")})
    df = rfm.group_means(df, "tenure_group", {"avg_monthly_by_tenure_group": V.mean_of("monthly_charges")})
    df = rfm.lag_in_cohort(df, {"prev_monetary_same_contract": "monetary_value"}, "recency_months",
                           rows_per_bucket, rows)
    df = df.select(
        "customer_id", "recency_months", "frequency_txn", "monetary_value", "monthly_charges", "contract",
        "tenure_group", "churn", "recency_ntile", "frequency_ntile", "monetary_ntile", "rfm_score", "risk_segment",
        "avg_totalcharges_by_contract", "avg_monthly_by_tenure_group", "prev_monetary_same_contract")
    return df.orderBy("rfm_score", "customer_id") if ordered else df


def enhanced_features(customers: DataFrame, computed_at: Column | None = None, ordered: bool = True,
                      rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """RFM features plus billing features and two risk segmentations, 31 columns."""
    rows = customers.count()
    df = features.billing_features(features.with_service_columns(customers), "sql")
    df = rfm.rfm_base(df.withColumn("tenure_group", V.tenure_group(F.col("tenure"))))
    df = rfm.rfm_score(rfm.rfm_tiles(df, True, rows_per_bucket, rows))
    df = rfm.add_risk_segment(df, ("High Risk", "Medium Risk", "Low Risk"))
    df = rfm.add_enhanced_risk_segment(df)
    df = rfm.cohort_benchmarks(df)
    df = rfm.lag_in_cohort(df, {
        "prev_monetary_same_contract": "monetary_value",
        "prev_monthly_same_contract": "monthly_charges",
    }, "recency_months", rows_per_bucket, rows)
    df = df.select(
        "customer_id", "recency_months", "frequency_txn", "monetary_value", "monthly_charges", "contract",
        "tenure_group", "churn", "avg_monthly_spend", "is_new_customer", "tenure_charge_ratio",
        "charge_per_tenure_plus1", "service_intensity", "electronic_check_flag", "auto_pay_flag",
        "partner_dependents_flag", "senior_and_new", "multi_services", "recency_ntile", "frequency_ntile",
        "monetary_ntile", "rfm_score", "risk_segment", "enhanced_risk_segment", "avg_totalcharges_by_contract",
        "avg_monthly_by_tenure_group", "avg_services_by_contract", "avg_tenure_charge_ratio_by_group",
        "prev_monetary_same_contract", "prev_monthly_same_contract",
        (F.current_timestamp() if computed_at is None else computed_at).alias("feature_computed_at"))
    if not ordered:
        return df
    return df.orderBy("rfm_score", F.col("enhanced_risk_segment").desc(), "customer_id")
