"""Scalar rules on customer columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cohort labels with the last month each one includes.
TENURE_GROUPS = [
    ("0-12 Months", 12),
    ("13-24 Months", 24),
    ("25-48 Months", 48),
    ("49-60 Months", 60),
    ("60+ Months", None),
]

# Service columns in table order.
SERVICE_COLUMNS = [
    "phone_service", "multiple_lines", "internet_service", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies",
]


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def number_or_zero(text: Column) -> Column:
    """Text to double; blank, malformed, NaN and NULL become 0."""
    parsed = F.nullif(F.trim(text), F.lit("")).try_cast("double")
    return F.nanvl(F.coalesce(parsed, F.lit(0.0)), F.lit(0.0))


def number_or_estimate(text: Column, monthly: Column, tenure: Column) -> Column:
    """Text to double; where there is no number, monthly charge times tenure."""
    parsed = F.nullif(F.trim(text), F.lit("")).try_cast("double")
    return F.coalesce(F.when(~F.isnan(parsed), parsed), monthly.cast("double") * tenure)


def yes_no(value: Column) -> Column:
    return F.when(value.isin("Yes", "No"), value)


def not_negative(value: Column) -> Column:
    """Negative to 0; NULL stays NULL (``greatest`` would turn it into 0)."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def tenure_group(tenure: Column) -> Column:
    """Cohort label; a NULL tenure falls into the last, open cohort."""
    label = None
    for name, last in TENURE_GROUPS:
        if last is None:
            return label.otherwise(F.lit(name))
        label = F.when(tenure <= last, name) if label is None else label.when(tenure <= last, name)


def tenure_bucket(tenure: Column) -> Column:
    """Cohort number 1..5; 0 without a tenure or below month 0."""
    number = F.when(tenure.isNull() | (tenure < 0), F.lit(0))
    for i, (_, last) in enumerate(TENURE_GROUPS, start=1):
        number = number.otherwise(F.lit(i)) if last is None else number.when(tenure <= last, F.lit(i))
    return number


def service_count(variant: str = "sql") -> Column:
    """Number of active services.

    ``sql``: any internet product counts. ``pandas``: only the literal 'Yes' counts, so
    internet never does. ``summary``: like ``sql`` but without multiple lines, and an
    internet value counts whenever it differs from 'No'.
    """
    internet = F.col("internet_service")
    counted = {
        "sql": internet.isNotNull() & ~internet.isin("No", "No internet service"),
        "pandas": internet == "Yes",
        "summary": internet != "No",
    }[variant]
    total = flag(counted)
    for name in SERVICE_COLUMNS:
        if name == "internet_service" or (name == "multiple_lines" and variant == "summary"):
            continue
        total = total + flag(F.col(name) == "Yes")
    return total


def risk_segment(score: Column, labels: tuple[str, str, str] = ("High Risk", "Medium Risk", "Low Risk")) -> Column:
    return F.when(score <= 7, labels[0]).when(score <= 11, labels[1]).otherwise(labels[2])


def enhanced_risk_segment(score: Column, e_check: Column, is_new: Column) -> Column:
    """Seven rules, the first match wins."""
    return (
        F.when(score <= 5, "Critical Risk")
        .when((score <= 7) & (e_check == 1), "Very High Risk")
        .when(score <= 7, "High Risk")
        .when((score <= 9) & (is_new == 1), "Medium-High Risk")
        .when(score <= 11, "Medium Risk")
        .when(score <= 13, "Low-Medium Risk")
        .otherwise("Low Risk")
    )


def half_up(value: Column, digits: int) -> Column:
    """Round by ``floor(x * 10^d + 0.5) / 10^d``: the same in every SQL engine."""
    scale = float(10 ** digits)
    return F.floor(value.cast("double") * scale + 0.5).cast("double") / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is 0 or NULL."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def mean_of(column: str) -> Column:
    """Average of a decimal column: an exact sum, then one division."""
    return ratio(F.sum(column), F.count(column))
