"""Tables and SQL texts: parameterised queries, writes, reloads, fallback loading."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def run_sql(spark: SparkSession, text: str, frames: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """Run a SQL text with ``:name`` parameters and, if wanted, ``{name}`` frames."""
    return spark.sql(text, args=params or None, **(frames or {}))


def run_sql_file(spark: SparkSession, path: str, frames: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """The same for a SQL file in any file system Spark can read."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return run_sql(spark, text, frames, **params)


def write_table(df: DataFrame, name: str, if_exists: str = "replace", path: str | None = None) -> None:
    """Save as a table: ``fail``, ``replace`` or ``append`` if it exists."""
    writer = df.write.mode(MODES[if_exists])
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int = 0, upper: int = 0, partitions: int = 1, **options) -> DataFrame:
    """A database table, read in parallel ranges of a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                                numPartitions=partitions)
    return reader.load()


def load_or_fallback(spark: SparkSession, table: str, path: str, force_table: bool = False,
                     order_column: str | None = None) -> DataFrame:
    """The table if there is one, else the file; with ``force_table`` a missing table is an error.

    Table rows get ``ingest_seq`` as rows of files do.
    """
    from churnlake.sources.files import load_customers, with_order

    if spark.catalog.tableExists(table):
        return with_order(spark.table(table), order_column)
    if force_table:
        raise RuntimeError(f"Table {table} was demanded but does not exist.")
    return load_customers(spark, path, order_column=order_column)


def reload_table(df: DataFrame, folder: str, rows_per_file: int = 5_000_000) -> DataFrame:
    """Replace a stored dataset and verify the row count.

    Each load goes to a new version folder; only after its count is checked does the
    one-line pointer file name it as current. A failed load leaves the old rows current.
    """
    spark = df.sparkSession
    version = f"{folder}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("maxRecordsPerFile", rows_per_file).parquet(version)
    loaded, expected = spark.read.schema(df.schema).parquet(version).count(), seen.get["rows"]
    if loaded != expected:
        raise RuntimeError(f"Load check failed: expected {expected} rows, got {loaded}")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/versions")
    return read_current(spark, folder)


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    """The dataset the last successful reload left behind."""
    newest = spark.read.text(f"{folder}/versions").agg(F.max("value").alias("v")).first()["v"]
    return spark.read.parquet(newest)
