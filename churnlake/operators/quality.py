"""Data-quality audit: counts of rule violations, one pass per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schema
from churnlake.operators.ordering import quantiles


def count_where(condition: Column) -> Column:
    """Rows where the condition is true; 0 for an empty table."""
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("long")


def _tall(df: DataFrame, counts: dict[str, Column], name: str = "check_name",
          value: str = "error_count") -> DataFrame:
    """All counts in one aggregation, then one row per count."""
    wide = df.agg(*[c.alias(n) for n, c in counts.items()])
    return wide.unpivot([], list(counts), name, value)


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, only columns that have some."""
    tall = _tall(df, {c: count_where(F.col(c).isNull()) for c in df.columns}, "column_name", "null_count")
    return tall.filter(F.col("null_count") > 0)


def duplicates(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(key).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def iqr_limits(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    low, high = quantiles(df, column, [0.25, 0.75])
    if low is None:
        return None, None
    return low - 1.5 * (high - low), high + 1.5 * (high - low)


def outside(column: str, limits: tuple[float | None, float | None]) -> Column:
    if limits[0] is None:
        return F.lit(False)
    value = F.col(column).cast("double")
    return (value < limits[0]) | (value > limits[1])


def outliers_iqr(df: DataFrame, column: str = "monthly_charges") -> DataFrame:
    limits = iqr_limits(df, column)
    return df.agg(count_where(outside(column, limits)).alias("outlier_count"),
                  F.count(F.lit(1)).alias("total_records"))


def zero_tenure_charged() -> Column:
    return (F.col("tenure") == 0) & (F.col("total_charges") > 0)


def billing_discrepancy() -> Column:
    """Billed total more than half away from monthly charge times tenure, after month 6."""
    expected = F.col("monthly_charges") * F.col("tenure")
    return (F.col("tenure") > 6) & (F.abs(expected - F.col("total_charges")) * 2 > expected)


def business_checks(df: DataFrame) -> DataFrame:
    return df.agg(count_where(zero_tenure_charged()).alias("zero_tenure_charged"),
                  count_where(billing_discrepancy()).alias("billing_discrepancy"))


def customer_rules() -> dict[str, Column]:
    rules = {f"{c}_allowed": F.col(c).isin(v) for c, v in schema.ALLOWED_VALUES.items()}
    return rules | {f"{c}_limit": F.expr(e) for c, e in schema.CUSTOMER_LIMITS.items()}


def prediction_rules() -> dict[str, Column]:
    return {f"{c}_limit": F.expr(e) for c, e in schema.PREDICTION_LIMITS.items()}


def constraint_violations(df: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """Violating rows per rule. A rule that is unknown (NULL) passes, as in a table check."""
    counts = {n: count_where(rule.eqNullSafe(False)) for n, rule in rules.items()}
    return _tall(df, counts, "rule", "violations").withColumn("table_name", F.lit(table))


def primary_key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that are NULL somewhere or occur more than once."""
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(missing | (F.col("row_count") > 1))
            .withColumn("reason", F.when(missing, "null").otherwise("duplicate")))


def foreign_key_orphans(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Child rows whose key is set but has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def cascade_delete(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Child rows that remain once their parents are gone."""
    return child.join(parent.select(key), key, "left_semi")


def quality_report(df: DataFrame, table: str = "customers", key: str = "customer_id",
                   checked_at: Column | None = None) -> DataFrame:
    """Every check as a row of the quality log: PASS, or WARNING / FAIL with a count.

    One pass for all row checks, one aggregation by key for the duplicates.
    """
    limits = iqr_limits(df, "monthly_charges")
    warnings = {f"nulls_{c}": F.col(c).isNull() for c in df.columns}
    warnings["outliers_monthly_charges"] = outside("monthly_charges", limits)
    failures = {"zero_tenure_charged": zero_tenure_charged(), "billing_discrepancy": billing_discrepancy()}
    failures |= {f"rule_{n}": r.eqNullSafe(False) for n, r in customer_rules().items()}
    checks = {n: count_where(c) for n, c in (warnings | failures).items()}
    wide = df.agg(F.count(F.lit(1)).alias("total_records"), *[c.alias(n) for n, c in checks.items()])
    rows = wide.unpivot(["total_records"], list(checks), "check_name", "error_count")
    per_key = df.groupBy(key).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_records"),
        F.lit("duplicate_keys").alias("check_name"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("error_count"))
    is_warning = F.col("check_name").isin(list(warnings))
    result = (F.when(F.col("error_count") == 0, "PASS").when(is_warning, "WARNING").otherwise("FAIL"))
    details = F.when(F.col("error_count") > 0, F.concat(
        F.lit("Found "), F.col("error_count").cast("string"), F.lit(" rows: "), F.col("check_name")))
    return rows.unionByName(per_key).select(
        F.lit(table).alias("table_name"), "check_name", result.alias("check_result"), "error_count",
        "total_records", details.alias("error_details"),
        (F.current_timestamp() if checked_at is None else checked_at).alias("checked_at"))
