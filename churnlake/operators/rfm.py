"""Recency, frequency, monetary scoring and cohort benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import values as V
from churnlake.operators.ordering import By, ROWS_PER_BUCKET, lag_in_group, ntile_global
from churnlake.session import attach, stage


def rfm_base(customers: DataFrame) -> DataFrame:
    """Tenure is the recency; with monthly billing the frequency is always 1."""
    return customers.withColumns({
        "recency_months": F.col("tenure"),
        "frequency_txn": F.lit(1),
        "monetary_value": F.col("total_charges"),
    })


def rfm_orderings(monetary_descending: bool = True) -> dict[str, By]:
    return {
        "recency_ntile": By("recency_months"),
        "frequency_ntile": By("frequency_txn", descending=True),
        "monetary_ntile": By("monetary_value", descending=monetary_descending),
    }


def rfm_score(df: DataFrame) -> DataFrame:
    return df.withColumn("rfm_score", F.col("recency_ntile") + F.col("frequency_ntile") + F.col("monetary_ntile"))


def add_risk_segment(df: DataFrame, labels: tuple[str, str, str]) -> DataFrame:
    return df.withColumn("risk_segment", V.risk_segment(F.col("rfm_score"), labels))


def add_enhanced_risk_segment(df: DataFrame) -> DataFrame:
    return df.withColumn("enhanced_risk_segment", V.enhanced_risk_segment(
        F.col("rfm_score"), F.col("electronic_check_flag"), F.col("is_new_customer")))


def group_means(df: DataFrame, group: str, means: dict[str, Column]) -> DataFrame:
    """Attach group averages to every row. NULL groups count as a group.

    The averages come from map-side partial sums and are joined back by broadcast while
    they are few; a window would send each of a handful of groups to one task.
    """
    return attach(df, df.groupBy(group).agg(*[m.alias(n) for n, m in means.items()]), [group])


def cohort_benchmarks(df: DataFrame) -> DataFrame:
    df = group_means(df, "contract", {
        "avg_totalcharges_by_contract": V.mean_of("total_charges"),
        "avg_services_by_contract": V.mean_of("multi_services"),
    })
    return group_means(df, "tenure_group", {
        "avg_monthly_by_tenure_group": V.mean_of("monthly_charges"),
        "avg_tenure_charge_ratio_by_group": F.avg("tenure_charge_ratio"),
    })


def lag_in_cohort(df: DataFrame, columns: dict[str, str], recency: str = "tenure",
                  rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None) -> DataFrame:
    """Value of the customer just before, by tenure, among those with the same contract."""
    return lag_in_group(df, "contract", By(recency), "customer_id", columns, rows_per_bucket, rows)


def rfm_tiles(df: DataFrame, monetary_descending: bool = True,
              rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None) -> DataFrame:
    return ntile_global(df, rfm_orderings(monetary_descending), "customer_id", 5, rows_per_bucket, rows)


def rfm_from_transactions(facts: DataFrame, customer: str, moment: str, amount_cents: Column,
                          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Score customers from a transaction table: last month, count and sum of cents.

    Recency counts months since the customer's last transaction; the most recent, most
    frequent and largest spenders get the top tile 5.
    """
    month = F.year(moment) * 12 + F.month(moment)
    per_customer = stage(facts.groupBy(F.col(customer).alias("customer_id")).agg(
        F.max(month).alias("last_month"),
        F.count(F.lit(1)).alias("frequency_txn"),
        F.sum(amount_cents).alias("monetary_cents"),
    ), "rfm-transactions")
    newest = per_customer.agg(F.max("last_month").alias("m")).first()["m"]
    df = per_customer.withColumn("recency_months", (F.lit(newest) - F.col("last_month")).cast("long")).drop("last_month")
    df = ntile_global(df, {
        "recency_ntile": By("recency_months", descending=True),
        "frequency_ntile": By("frequency_txn"),
        "monetary_ntile": By("monetary_cents"),
    }, "customer_id", 5, rows_per_bucket)
    return rfm_score(df)
