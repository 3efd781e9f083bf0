"""Customer features: one projection, with group means and a quantile attached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import values as V
from churnlake.functions.values import flag
from churnlake.operators.ordering import quantiles
from churnlake.session import attach

UNPROTECTED = ["No", "No internet service"]


def with_service_columns(df: DataFrame) -> DataFrame:
    """Service columns a feed lacks, as NULL."""
    return df.withColumns({c: F.lit(None).cast("string") for c in V.SERVICE_COLUMNS if c not in df.columns})


def billing_features(df: DataFrame, variant: str = "sql") -> DataFrame:
    """The ten features known to both the SQL and the file path."""
    tenure, monthly, total = (F.col(c).cast("double") for c in ("tenure", "monthly_charges", "total_charges"))
    df = df.withColumns({
        "avg_monthly_spend": F.when(F.col("tenure") > 0, total / tenure).otherwise(monthly),
        "is_new_customer": flag(F.col("tenure") <= 12),
        "tenure_charge_ratio": tenure / (monthly + 1),
        "charge_per_tenure_plus1": total / (tenure + 1),
        "electronic_check_flag": flag(F.col("payment_method") == "Electronic check"),
        "auto_pay_flag": flag(F.lower("payment_method").contains("automatic")),
        "partner_dependents_flag": flag((F.col("partner") == "Yes") & (F.col("dependents") == "Yes")),
        "senior_and_new": flag((F.col("senior_citizen") == 1) & (F.col("tenure") <= 12)),
        "multi_services": V.service_count(variant),
    })
    return df.withColumn("service_intensity", monthly / (F.col("avg_monthly_spend") + 1))


def service_counts(df: DataFrame) -> DataFrame:
    df = with_service_columns(df)
    return df.select("customer_id", *[
        V.service_count(v).alias(f"services_{v}") for v in ("sql", "pandas", "summary")])


def fit_reference(df: DataFrame) -> tuple[float | None, DataFrame]:
    """What the features need from a whole table: the 70 % monthly charge, contract means.

    Fit on the training rows for modelling, on the whole table for reporting.
    """
    threshold = quantiles(df, "monthly_charges", [0.70])[0]
    means = (df.filter(F.col("contract").isNotNull()).groupBy("contract")
             .agg(V.mean_of("monthly_charges").alias("contract_avg")))
    return threshold, means


def customer_features(df: DataFrame, fit_on: DataFrame | None = None, variant: str = "pandas") -> DataFrame:
    """All features and the label ``churned``; keeps the input columns."""
    high, contract_means = fit_reference(fit_on if fit_on is not None else df)
    df = billing_features(with_service_columns(df), variant)
    df = attach(df, contract_means, ["contract"])
    internet = F.col("internet_service")
    no_security, no_backup, no_support = (
        F.coalesce(F.col(c).isin(UNPROTECTED), F.lit(False))
        for c in ("online_security", "online_backup", "tech_support"))
    streams = (F.col("streaming_tv") == "Yes") | (F.col("streaming_movies") == "Yes")
    above: Column = F.lit(0) if high is None else flag(F.col("monthly_charges").cast("double") > F.lit(high))
    df = df.withColumns({
        "tenure_group": V.tenure_group(F.col("tenure")),
        "contract_mtm": flag(F.col("contract") == "Month-to-month"),
        "fiber_optic_flag": flag(internet == "Fiber optic"),
        "no_protection": flag(~internet.eqNullSafe("No") & no_security & no_backup & no_support),
        "streaming_no_protect": flag(streams & no_security & no_support),
        "high_monthly_charges": above,
        "services_x_tenure": F.col("multi_services") * F.col("tenure"),
        "charge_vs_contract_avg": F.col("monthly_charges").cast("double") / (F.col("contract_avg") + 1),
        "tenure_bucket_num": V.tenure_bucket(F.col("tenure")),
        "tenure_sq": F.col("tenure").cast("long") * F.col("tenure"),
        "charges_x_tenure": F.col("monthly_charges").cast("double") * F.col("tenure"),
        "churned": flag(F.col("churn") == "Yes"),
    })
    return df.withColumns({
        "mtm_new_customer": F.col("contract_mtm") * F.col("is_new_customer"),
        "fiber_no_protect": F.col("fiber_optic_flag") * F.col("no_protection"),
        "echeck_mtm": F.col("electronic_check_flag") * F.col("contract_mtm"),
    }).drop("contract_avg")


# Feature columns by kind, as the models use them.
NUMERIC_FEATURES = [
    "senior_citizen", "tenure", "monthly_charges", "total_charges",
    "avg_monthly_spend", "is_new_customer", "tenure_charge_ratio", "charge_per_tenure_plus1",
    "service_intensity", "senior_and_new", "electronic_check_flag", "auto_pay_flag",
    "partner_dependents_flag", "multi_services", "contract_mtm", "fiber_optic_flag",
    "no_protection", "streaming_no_protect", "high_monthly_charges", "services_x_tenure",
    "charge_vs_contract_avg", "tenure_bucket_num", "mtm_new_customer", "fiber_no_protect",
    "tenure_sq", "echeck_mtm", "charges_x_tenure",
]
CATEGORICAL_FEATURES = [
    "gender", "partner", "dependents", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract", "paperless_billing", "payment_method", "tenure_group",
]
