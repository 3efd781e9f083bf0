"""Dashboard tables. Inputs of any size, outputs of a few rows."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import values as V
from churnlake.operators.ordering import quantiles, quantiles_by
from churnlake.session import attach

RETENTION_RATES = [20, 30, 40, 50]      # fixed values: percent
MONTHLY_REVENUE_CENTS = 6476            # fixed value: average monthly revenue in cents


def churned() -> Column:
    return F.col("churn") == "Yes"


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("long")


def churn_distribution(df: DataFrame) -> DataFrame:
    """Customers per churn value - both values always present - and the churn rate in %."""
    wide = df.agg(rows_where(F.col("churn") == "No").alias("No"), rows_where(churned()).alias("Yes"))
    rate = V.ratio(F.col("Yes") * 100, F.col("Yes") + F.col("No"))
    return wide.withColumn("churn_rate_pct", rate).unpivot(
        ["churn_rate_pct"], ["No", "Yes"], "churn", "customers").select("churn", "customers", "churn_rate_pct")


def churn_rate_by_contract(df: DataFrame) -> DataFrame:
    rates = df.filter(F.col("contract").isNotNull()).groupBy("contract").agg(
        V.ratio(rows_where(churned()) * 100, F.count(F.lit(1))).alias("churn_rate_pct"))
    return rates.orderBy(F.col("churn_rate_pct").desc(), "contract")


def churn_by_contract_pivot(df: DataFrame) -> DataFrame:
    known = df.filter(F.col("contract").isNotNull() & F.col("customer_id").isNotNull())
    table = known.groupBy("contract").pivot("churn", ["No", "Yes"]).count().na.fill(0, ["No", "Yes"])
    table = table.withColumn("churn_rate", V.ratio(F.col("Yes"), F.col("Yes") + F.col("No")))
    return table.filter(F.col("Yes") + F.col("No") > 0).orderBy("contract")


def cohort_churn_analysis(df: DataFrame) -> DataFrame:
    """Per tenure cohort; rows without a tenure belong to none."""
    known = df.filter(F.col("tenure").isNotNull() & (F.col("tenure") >= 0))
    table = known.groupBy(V.tenure_group(F.col("tenure")).alias("tenure_group")).agg(
        F.count("customer_id").alias("Total_Customers"), rows_where(churned()).alias("Churned"))
    return table.select(
        "tenure_group", "Total_Customers", "Churned",
        (F.col("Total_Customers") - F.col("Churned")).alias("Retained"),
        V.half_up(V.ratio(F.col("Churned") * 100, F.col("Total_Customers")), 2).alias("Churn_Rate_Pct"),
    ).orderBy("tenure_group")


def risk_scorecard(predictions: DataFrame) -> DataFrame:
    """Per risk segment, from rows with Risk_Segment, Actual and Churn_Probability."""
    probability = F.col("Churn_Probability").cast("decimal(18,4)")
    return predictions.groupBy("Risk_Segment").agg(
        F.count("Actual").alias("Customer_Count"),
        V.half_up(V.ratio(F.sum(probability), F.count(probability)), 4).alias("Avg_Churn_Prob"),
        V.half_up(V.ratio(F.sum("Actual"), F.count("Actual")), 4).alias("Actual_Churn_Rate"),
    ).orderBy("Risk_Segment")


def confusion_matrix(scored: DataFrame, threshold: float = 0.5, score: str = "score",
                     label: str = "label") -> DataFrame:
    """Actual by predicted counts at the given threshold; both rows are always there."""
    hit = F.col(score) >= threshold
    cells = scored.agg(
        rows_where((F.col(label) == 1) & hit).alias("tp"), rows_where((F.col(label) == 1) & ~hit).alias("fn"),
        rows_where((F.col(label) == 0) & hit).alias("fp"), rows_where((F.col(label) == 0) & ~hit).alias("tn"))
    rows = F.array(
        F.struct(F.lit("Churn").alias("Actual"), F.col("tp").alias("Churn"), F.col("fn").alias("No Churn")),
        F.struct(F.lit("No Churn").alias("Actual"), F.col("fp").alias("Churn"), F.col("tn").alias("No Churn")))
    return cells.select(F.inline(rows))


def roi_calculator(scored: DataFrame, score: str = "score", revenue_cents: int = MONTHLY_REVENUE_CENTS,
                   rates: list[int] | None = None) -> DataFrame:
    """Revenue kept if a share of the top 15 % by score is retained; cents stay whole."""
    limit = quantiles(scored, score, [0.85])[0]
    above = F.lit(False) if limit is None else F.col(score) >= F.lit(limit)
    counted = scored.agg(rows_where(above).alias("High_Risk_Customers"))
    rate = F.explode(F.array(*[F.lit(r) for r in (rates or RETENTION_RATES)])).alias("rate")
    saved = F.floor((F.col("High_Risk_Customers") * revenue_cents * F.col("rate") + 50) / 100)
    return counted.select("High_Risk_Customers", rate).select(
        F.concat(F.col("rate").cast("string"), F.lit("%")).alias("Retention_Rate"),
        "High_Risk_Customers",
        F.lit(revenue_cents / 100.0).alias("Avg_Monthly_Revenue_USD"),
        (saved.cast("double") / 100.0).alias("Monthly_Saved_USD"),
        ((saved * 12).cast("double") / 100.0).alias("Annual_Saved_USD"))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair in one pass, rows where both are present."""
    columns = columns or ["tenure", "monthly_charges", "total_charges"]
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                    for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("correlation"))
             for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])]
    return wide.select(F.inline(F.array(*cells)))


def quantile_table(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    values = quantiles(df, column, probabilities)
    return df.sparkSession.createDataFrame(
        list(zip(map(float, probabilities), values)), "probability double, value double")


def boxplot_stats(df: DataFrame, column: str = "monthly_charges", by: str = "churn",
                  groups: tuple[str, ...] = ("No", "Yes")) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outliers per group; no row for a group without values.

    One table of counts gives the quartiles of all groups; one more pass the rest.
    """
    rows = df.filter(F.col(by).isin(*groups)).select(by, F.col(column).cast("double").alias("v"))
    quarters = quantiles_by(rows, by, "v", [0.25, 0.5, 0.75]).toDF(by, "q1", "median", "q3")
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= low) & (F.col("v") <= high)
    return attach(rows, quarters, [by]).filter(F.col("q1").isNotNull()).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"), F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        rows_where(~inside).alias("outliers"))


def numeric_summary(df: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and median of the amounts; customers at tenure 0. One table of counts for all medians."""
    columns = ["tenure", "monthly_charges", "total_charges"]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                         for c in columns])).alias("c")).select("c.*")
    medians = quantiles_by(long, "column_name", "v", [0.5]).withColumnRenamed("q0", "median_value")
    wide = df.agg(
        rows_where(F.col("tenure") == 0).alias("zero_tenure"),
        *[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))],
        *[V.mean_of(c).alias(f"mean_{c}") for c in columns])
    rest = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"min_{c}").alias("min_value"), F.col(f"max_{c}").alias("max_value"),
        F.col(f"mean_{c}").alias("mean_value"),
        (F.col("zero_tenure") if c == "tenure" else F.lit(None).cast("long")).alias("zero_count")) for c in columns])))
    return rest.join(medians, "column_name", "left").select(
        "column_name", "min_value", "max_value", "mean_value", "median_value", "zero_count")


SEGMENT_TYPES = ["contract", "tenure_group", "risk_segment", "payment_method"]


def churn_analytics(df: DataFrame, analysis_date: Column | None = None) -> DataFrame:
    """One row per value of each segment column, and one for all customers.

    ``df`` has the segment columns, amounts and churn. Revenue is the sum of monthly
    charges; the opportunity is the revenue of high-risk customers who have not churned.
    """
    grouped = df.groupingSets([[F.col(c)] for c in SEGMENT_TYPES] + [[]], *[F.col(c) for c in SEGMENT_TYPES]).agg(
        F.grouping_id().alias("g"),
        F.count(F.lit(1)).alias("total_customers"),
        rows_where(churned()).alias("churned_customers"),
        V.half_up(V.mean_of("monthly_charges"), 2).alias("avg_monthly_charges"),
        V.half_up(V.mean_of("total_charges"), 2).alias("avg_total_charges"),
        V.half_up(V.mean_of("tenure"), 2).alias("avg_tenure"),
        F.sum("monthly_charges").cast("double").alias("total_revenue"),
        F.coalesce(F.sum(F.when(churned(), F.col("monthly_charges"))), F.lit(0)).cast("double").alias("lost_revenue"),
        F.coalesce(F.sum(F.when(
            (F.col("churn") == "No") & (F.col("risk_segment_value") == "High Risk"), F.col("monthly_charges"))),
            F.lit(0)).cast("double").alias("retention_opportunity"))
    last = len(SEGMENT_TYPES) - 1
    kind, value = F.lit("all"), F.lit("all")
    for i, c in enumerate(SEGMENT_TYPES):
        here = F.col("g") == (2 ** len(SEGMENT_TYPES) - 1 - 2 ** (last - i))
        kind, value = F.when(here, F.lit(c)).otherwise(kind), F.when(here, F.col(c)).otherwise(value)
    return grouped.select(
        (F.current_date() if analysis_date is None else analysis_date).alias("analysis_date"),
        kind.alias("segment_type"), value.alias("segment_value"), "total_customers", "churned_customers",
        V.half_up(V.ratio(F.col("churned_customers"), F.col("total_customers")), 4).alias("churn_rate"),
        "avg_monthly_charges", "avg_total_charges", "avg_tenure", "total_revenue", "lost_revenue",
        "retention_opportunity")
