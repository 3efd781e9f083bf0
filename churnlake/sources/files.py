"""Customer files in, report files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import schema
from churnlake.operators.cleaning import require_columns


def with_order(df: DataFrame, order_column: str | None = None) -> DataFrame:
    """``df`` with ``ingest_seq``: the named column, else one it has, else the order in which Spark reads the rows."""
    if order_column:
        return df.withColumn("ingest_seq", F.col(order_column))
    return df if "ingest_seq" in df.columns else df.withColumn("ingest_seq", F.monotonically_increasing_id())


def load_customers(spark: SparkSession, path: str, required: list[str] | None = None,
                   file_format: str | None = None, order_column: str | None = None) -> DataFrame:
    """Raw customer CSV (or Parquet) with the required-column check; nothing is inferred.

    ``file_format`` is ``csv`` or ``parquet``; without it the suffix of the path decides.

    Columns are matched by header name, so their order in the file is free. The added
    ``ingest_seq`` orders rows by file, block and line, so that "first row" has a meaning.
    """
    if (file_format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")) == "parquet":
        return with_order(require_columns(spark.read.parquet(path), required or schema.REQUIRED_RAW), order_column)
    text = spark.read.option("header", True).csv(path)
    require_columns(text, required or schema.REQUIRED_RAW)
    types = {f.name: f.dataType for f in schema.RAW_SCHEMA.fields}
    return text.select(*[
        text[f"`{c}`"].try_cast(types[c]).alias(c) if c in types else text[f"`{c}`"] for c in text.columns],
        F.struct("_metadata.file_path", "_metadata.file_block_start",
                 F.monotonically_increasing_id().alias("line")).alias("ingest_seq"))


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for report tables of a few rows only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
