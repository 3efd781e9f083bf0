"""Cleaning of raw customer rows, segment filters and the customer summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schema
from churnlake.functions import values as V

YES_NO_COLUMNS = ["partner", "dependents", "phone_service", "paperless_billing", "churn"]
AMOUNT_COLUMNS = ["tenure", "monthly_charges", "total_charges"]


def rename_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, blanks to underscores, then the table's snake_case names."""
    lowered = {c: c.lower().replace(" ", "_") for c in df.columns}
    return df.withColumnsRenamed({c: schema.RENAMES.get(low, low) for c, low in lowered.items()})


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def clean_total_charges(df: DataFrame) -> DataFrame:
    return df.withColumn("total_charges", V.number_or_zero(F.col("total_charges").cast("string")))


def impute_total_charges(df: DataFrame) -> DataFrame:
    """The other rule for missing totals: monthly charge times tenure."""
    return df.withColumn("total_charges", V.number_or_estimate(
        F.col("total_charges").cast("string"), F.col("monthly_charges"), F.col("tenure")))


def clean_yes_no(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    present = [c for c in (columns or YES_NO_COLUMNS) if c in df.columns]
    return df.withColumns({c: V.yes_no(F.col(c)) for c in present})


def clean_int(df: DataFrame, column: str = "senior_citizen") -> DataFrame:
    """Whole number, NULL where there is none (the quality audit counts those)."""
    return df.withColumn(column, F.col(column).try_cast("int"))


def clip_negative(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    present = [c for c in (columns or AMOUNT_COLUMNS) if c in df.columns]
    return df.withColumns({c: V.not_negative(F.col(c)) for c in present})


def dedupe_customers(df: DataFrame, key: str = "customer_id", order: str = "ingest_seq") -> DataFrame:
    """First row per key in ``order``.

    ``min_by`` combines on the map side, so the copies of one key never meet in one
    task: each task sends at most one row per key.
    """
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("first"))
    return first.select(key, "first.*").select(*df.columns)


def add_tenure_group(df: DataFrame) -> DataFrame:
    return df.withColumn("tenure_group", V.tenure_group(F.col("tenure")))


def clean_customers(raw: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Raw rows to the customers table: all row-wise steps, then one shuffle to dedupe."""
    df = require_columns(rename_columns(raw), schema.REQUIRED_CLEAN)
    df = clip_negative(clean_int(clean_yes_no(clean_total_charges(df))))
    df = df.withColumns({
        "monthly_charges": F.col("monthly_charges").cast(schema.MONTHLY_TYPE),
        "total_charges": F.col("total_charges").cast(schema.TOTAL_TYPE),
    })
    return dedupe_customers(df, order=order)


def store_segments(df: DataFrame, path: str, ranges: int | None = None) -> DataFrame:
    """Store customers so that a segment reads its part alone: a folder per churn value, in it files by range of tenure and charge.

    Churn may be very uneven: ranges are cut over churn, tenure and charge together, so a hot value is many files.
    Without ``ranges`` Spark cuts them to its advisory size, and a small table is one range.
    """
    order = ["churn", "tenure", "monthly_charges"]
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.partitionBy("churn").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def filter_segment(df: DataFrame, segment: str) -> DataFrame:
    """One of the segments. Over ``store_segments`` the churn filter prunes folders, the others reach the scan as pushed filters."""
    conditions: dict[str, Column] = {
        "churned": F.col("churn") == "Yes",
        "high_value": F.col("monthly_charges") > 50,
        "long_tenure": F.col("tenure") > 24,
    }
    return df.filter(conditions[segment])


def unexpired(df: DataFrame, as_of: Column) -> DataFrame:
    return df.filter(F.col("expires_at").isNull() | (F.col("expires_at") > as_of))


def payment_text_search(df: DataFrame, words: list[str], column: str = "payment_method") -> DataFrame:
    """Rows whose text holds every one of the words, whole words, any case."""
    text = F.split(F.trim(F.lower(F.regexp_replace(column, "[^a-zA-Z]+", " "))), " ")
    return df.filter(F.forall(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.array_contains(text, w)))


def customer_summary(df: DataFrame) -> DataFrame:
    profile = ["customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure"]
    account = ["contract", "payment_method", "monthly_charges", "total_charges", "churn"]
    kept = ["created_at"] if "created_at" in df.columns else []
    return df.select(
        *profile, V.tenure_group(F.col("tenure")).alias("tenure_group"), *account,
        V.service_count("summary").alias("total_services"), *kept,
    )
