"""A telco-shaped customer feed derived from the order tables.

One account per customer: urgent orders mark the billing months (first to last gives the
tenure, last to the end of the table gives the idle time), the smallest order sets the
monthly charge. Customers in debt were entered twice, some values are dirty, some missing.
The same text runs in Spark and in the oracle; ``{orders}``, ``{customer}`` and
``{copies}`` are filled in per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FEED_SQL = """
SELECT
  k + 10000000000 * copy_no AS ingest_seq,
  c_name AS "customerID",
  CASE WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CAST(CASE WHEN k % 107 = 0 THEN NULL WHEN k % 6 = 0 THEN 1 ELSE 0 END AS INT) AS "SeniorCitizen",
  CASE WHEN k % 97 = 0 THEN 'Y' WHEN k % 2 = 1 THEN 'Yes' ELSE 'No' END AS "Partner",
  CASE WHEN k % 10 < 3 THEN 'Yes' ELSE 'No' END AS "Dependents",
  CAST(CASE WHEN k % 83 = 0 THEN NULL ELSE months END AS INT) AS tenure,
  CASE WHEN k % 10 = 9 THEN 'No' ELSE 'Yes' END AS "PhoneService",
  CASE WHEN k % 10 = 9 THEN 'No phone service' WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
  CASE WHEN nk % 5 = 0 THEN 'No' WHEN nk % 5 < 3 THEN 'Fiber optic' ELSE 'DSL' END AS "InternetService",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 7 < 2 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 11 < 4 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 13 < 5 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 17 < 5 THEN 'Yes' ELSE 'No' END AS "TechSupport",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 19 < 8 THEN 'Yes' ELSE 'No' END AS "StreamingTV",
  CASE WHEN nk % 5 = 0 THEN 'No internet service' WHEN k % 23 < 9 THEN 'Yes' ELSE 'No' END AS "StreamingMovies",
  CASE WHEN k % 89 = 0 THEN NULL WHEN seg = 'HOUSEHOLD' THEN 'Two year' WHEN seg = 'FURNITURE' THEN 'One year'
       ELSE 'Month-to-month' END AS "Contract",
  CASE WHEN k % 5 < 3 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
  CASE WHEN copy_no = 1 THEN 'Mailed check' WHEN nk % 4 = 0 THEN 'Electronic check'
       WHEN nk % 4 = 1 THEN 'Mailed check' WHEN nk % 4 = 2 THEN 'Bank transfer (automatic)'
       ELSE 'Credit card (automatic)' END AS "PaymentMethod",
  CAST(CASE WHEN k % 101 = 0 THEN -cents ELSE cents END / 100.0 AS DOUBLE) AS "MonthlyCharges",
  CASE WHEN k % 103 = 0 THEN 'n/a' WHEN months = 0 AND k % 10 <> 0 THEN ' '
       ELSE CONCAT(CAST(CAST(FLOOR(billed / 100) AS BIGINT) AS VARCHAR(20)), '.',
                   LPAD(CAST(billed % 100 AS VARCHAR(20)), 2, '0')) END AS "TotalCharges",
  CASE WHEN idle_m > 36 + CASE WHEN seg IN ('HOUSEHOLD', 'FURNITURE') THEN 14 ELSE 0 END
       THEN 'Yes' ELSE 'No' END AS "Churn",
  nk AS region_no
FROM (
  SELECT e.*, {copies} AS copy_no,
         cents * CASE WHEN k % 25 = 0 THEN 2 * months + 1 ELSE months END AS billed
  FROM (
    SELECT c.c_custkey AS k, c.c_name, c.c_nationkey AS nk, c.c_mktsegment AS seg, c.c_acctbal AS balance,
           CAST(COALESCE(o.last_m - o.first_m, 0) AS BIGINT) AS months,
           COALESCE((SELECT MAX(YEAR(o_orderdate) * 12 + MONTH(o_orderdate)) FROM {orders}) - o.last_m, 999) AS idle_m,
           CAST(2000 + COALESCE(FLOOR(o.low_cents / 1500.0), c.c_custkey % 3000) AS BIGINT) AS cents
    FROM {customer} c LEFT JOIN (
      SELECT o_custkey,
             MIN(CASE WHEN o_orderpriority = '1-URGENT' THEN YEAR(o_orderdate) * 12 + MONTH(o_orderdate) END) AS first_m,
             MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN YEAR(o_orderdate) * 12 + MONTH(o_orderdate) END) AS last_m,
             MIN(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS low_cents
      FROM {orders} GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey) e) f
"""

SPARK_COPIES = "EXPLODE(CASE WHEN balance < 0 THEN ARRAY(0, 1) ELSE ARRAY(0) END)"
ORACLE_COPIES = "UNNEST(CASE WHEN balance < 0 THEN [0, 1] ELSE [0] END)"


# Layouts of the given tables: stated, so that no job has to read file footers first.
LAYOUTS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{folder}/{name}.parquet")


def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw customers: the raw file's columns plus ``ingest_seq`` and ``region_no``."""
    text = FEED_SQL.replace('"', "`").replace("{copies}", SPARK_COPIES)
    return spark.sql(
        text,
        orders=read_table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"),
        customer=read_table(spark, folder, "customer"),
    )
