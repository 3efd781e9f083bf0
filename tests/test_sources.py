"""Input branches, the stored feature rows, and reports on empty tables."""

import pytest
from pyspark.sql import functions as F

from churnlake.operators.cleaning import clean_customers
from churnlake.operators.reports import boxplot_stats
from churnlake.operators.store import latest_features, to_feature_rows, write_feature_rows
from churnlake.session import new_path
from churnlake.sources.files import load_customers
from churnlake.sources.tables import load_or_fallback, run_sql_file, write_table


def test_parquet_rows_can_be_cleaned(spark, raw):
    want = raw.select("customerID").distinct().count()
    path = new_path(spark, "raw-parquet")
    raw.withColumnRenamed("ingest_seq", "line").write.parquet(path)
    named = load_customers(spark, path, file_format="parquet", order_column="line")
    assert clean_customers(named).count() == want
    assert clean_customers(load_customers(spark, path, file_format="parquet")).count() == want


def test_table_branch_and_forced_table(spark, raw, tmp_path):
    with pytest.raises(RuntimeError):
        load_or_fallback(spark, "no_such_customers", "nowhere", force_table=True)
    name = "customers_of_test_sources"
    for _ in range(2):
        write_table(raw.drop("ingest_seq"), name, "replace", new_path(spark, "raw-table"))
    try:
        found = load_or_fallback(spark, name, "nowhere", force_table=True)
        assert clean_customers(found).count() == raw.select("customerID").distinct().count()
    finally:
        spark.sql(f"DROP TABLE {name}")
    text = tmp_path / "q.sql"
    text.write_text("SELECT :a + 1 AS b")
    assert run_sql_file(spark, str(text), a=1).first()["b"] == 2


def test_store_reads_no_later_folder(spark, customers):
    path = new_path(spark, "store")
    for day in ("2024-01-01", "2024-03-01"):
        write_feature_rows(to_feature_rows(customers, ["tenure"], F.lit(day).cast("timestamp_ntz")), path)
    store = spark.read.parquet(path)
    found = latest_features(store, F.lit("2024-02-01").cast("timestamp_ntz"))
    assert found.select("computed_at").distinct().count() == 1 and found.count() == customers.count()
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(computed_on" in scan and "<= 2024-02-01" in scan.split("PartitionFilters", 1)[1]


def test_boxplot_of_no_rows(customers):
    assert boxplot_stats(customers.limit(0)).count() == 0
