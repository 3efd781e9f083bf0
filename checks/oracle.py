"""The same queries in plain SQL, written separately from the library."""

from __future__ import annotations

from checks.inputs import SCORE_COLUMNS, SCORE_SQL
from churnlake import schema
from churnlake.sources.telco import FEED_SQL, ORACLE_COPIES

RAW = FEED_SQL.replace("{copies}", ORACLE_COPIES).replace("{orders}", "orders").replace("{customer}", "customer")

RENAMED = """
SELECT ingest_seq, "customerID" AS customer_id, gender, "SeniorCitizen" AS senior_citizen, "Partner" AS partner,
  "Dependents" AS dependents, tenure, "PhoneService" AS phone_service, "MultipleLines" AS multiple_lines,
  "InternetService" AS internet_service, "OnlineSecurity" AS online_security, "OnlineBackup" AS online_backup,
  "DeviceProtection" AS device_protection, "TechSupport" AS tech_support, "StreamingTV" AS streaming_tv,
  "StreamingMovies" AS streaming_movies, "Contract" AS contract, "PaperlessBilling" AS paperless_billing,
  "PaymentMethod" AS payment_method, "MonthlyCharges" AS monthly_charges, "TotalCharges" AS total_charges,
  "Churn" AS churn, region_no FROM raw
"""

# Amounts as double here; they hold whole cents, so exact sums go through a decimal.
CUSTOMERS = """
SELECT ingest_seq, customer_id, gender, senior_citizen,
  CASE WHEN partner IN ('Yes', 'No') THEN partner END AS partner,
  CASE WHEN dependents IN ('Yes', 'No') THEN dependents END AS dependents,
  CASE WHEN tenure < 0 THEN 0 ELSE tenure END AS tenure,
  CASE WHEN phone_service IN ('Yes', 'No') THEN phone_service END AS phone_service,
  multiple_lines, internet_service, online_security, online_backup, device_protection, tech_support,
  streaming_tv, streaming_movies, contract,
  CASE WHEN paperless_billing IN ('Yes', 'No') THEN paperless_billing END AS paperless_billing,
  payment_method,
  CASE WHEN monthly_charges < 0 THEN 0.0 ELSE monthly_charges END AS monthly_charges,
  GREATEST(COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), 0), 0) AS total_charges,
  CASE WHEN churn IN ('Yes', 'No') THEN churn END AS churn, region_no,
  CASE WHEN tenure <= 12 THEN '0-12 Months' WHEN tenure <= 24 THEN '13-24 Months' WHEN tenure <= 48 THEN '25-48 Months'
       WHEN tenure <= 60 THEN '49-60 Months' ELSE '60+ Months' END AS tenure_group
FROM renamed QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ingest_seq) = 1
"""


def _mean(c: str, over: str = "") -> str:
    return (f"CAST(SUM(CAST({c} AS DECIMAL(18, 2))){over} AS DOUBLE) / CAST(COUNT({c}){over} AS DOUBLE)")


def _half_up(x: str, digits: int) -> str:
    return f"FLOOR(({x}) * {10 ** digits}.0::DOUBLE + 0.5) / {10 ** digits}.0::DOUBLE"


def _yes(c: str) -> str:
    return f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1 ELSE 0 END"


_SERVICES = ["phone_service", "multiple_lines", "online_security", "online_backup", "device_protection",
             "tech_support", "streaming_tv", "streaming_movies"]
SERVICES_SQL = " + ".join(_yes(c) for c in _SERVICES) + \
    " + CASE WHEN internet_service IS NOT NULL AND internet_service NOT IN ('No', 'No internet service') THEN 1 ELSE 0 END"
SERVICES_PANDAS = " + ".join(_yes(c) for c in _SERVICES + ["internet_service"])
SERVICES_SUMMARY = " + ".join(_yes(c) for c in _SERVICES if c != "multiple_lines") + \
    " + CASE WHEN internet_service <> 'No' THEN 1 ELSE 0 END"

BILLING = f"""
SELECT b.*, monthly_charges / (avg_monthly_spend + 1) AS service_intensity FROM (
  SELECT c.*,
    CASE WHEN tenure > 0 THEN total_charges / tenure ELSE monthly_charges END AS avg_monthly_spend,
    {_flag("tenure <= 12")} AS is_new_customer,
    tenure / (monthly_charges + 1) AS tenure_charge_ratio,
    total_charges / (tenure + 1) AS charge_per_tenure_plus1,
    {_flag("senior_citizen = 1 AND tenure <= 12")} AS senior_and_new,
    {_flag("payment_method = 'Electronic check'")} AS electronic_check_flag,
    {_flag("LOWER(payment_method) LIKE '%automatic%'")} AS auto_pay_flag,
    {_flag("partner = 'Yes' AND dependents = 'Yes'")} AS partner_dependents_flag,
    {SERVICES_SQL} AS multi_services, {SERVICES_PANDAS} AS services_pandas
  FROM customers c) b
"""

TILED = """
SELECT b.*, recency_ntile + frequency_ntile + monetary_ntile AS rfm_score FROM (
  SELECT f.*,
    CAST(NTILE(5) OVER (ORDER BY tenure ASC NULLS LAST, customer_id) AS INT) AS recency_ntile,
    CAST(NTILE(5) OVER (ORDER BY customer_id) AS INT) AS frequency_ntile,
    CAST(NTILE(5) OVER (ORDER BY total_charges DESC NULLS FIRST, customer_id) AS INT) AS monetary_ntile
  FROM billing f) b
"""

LAG = "LAG({}) OVER (PARTITION BY contract ORDER BY tenure ASC NULLS LAST, customer_id)"
RISK = "CASE WHEN rfm_score <= 7 THEN 'High Risk' WHEN rfm_score <= 11 THEN '{} Risk' ELSE 'Low Risk' END"
ENHANCED_RISK = """CASE WHEN rfm_score <= 5 THEN 'Critical Risk'
  WHEN rfm_score <= 7 AND electronic_check_flag = 1 THEN 'Very High Risk' WHEN rfm_score <= 7 THEN 'High Risk'
  WHEN rfm_score <= 9 AND is_new_customer = 1 THEN 'Medium-High Risk' WHEN rfm_score <= 11 THEN 'Medium Risk'
  WHEN rfm_score <= 13 THEN 'Low-Medium Risk' ELSE 'Low Risk' END"""

SCORED = "SELECT s.*, score_logistic_regression AS score FROM (SELECT c.*, " + ", ".join(
    f"CAST(LEAST(CAST({SCORE_SQL[m]} AS BIGINT), 9999) AS DOUBLE) / 10000.0::DOUBLE AS {c}"
    for m, c in SCORE_COLUMNS.items()) + ", CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label FROM customers c) s"


def _feature_rows(computed: str, expires: str | None, where: str = "TRUE") -> str:
    end = f"TIMESTAMP '{expires} 00:00:00'" if expires else "CAST(NULL AS TIMESTAMP)"
    return " UNION ALL ".join(
        f"SELECT customer_id, '{f}' AS feature_name, CAST({f} AS DOUBLE) AS feature_value, 'numeric' AS feature_type,"
        f" TIMESTAMP '{computed} 00:00:00' AS computed_at, {end} AS expires_at FROM customers WHERE {where}"
        for f in ("tenure", "monthly_charges", "total_charges", "senior_citizen"))


FEATURE_HISTORY = " UNION ALL ".join([
    _feature_rows("2024-01-01", "2024-03-01"), _feature_rows("2024-02-01", None, "churn = 'No'"),
    _feature_rows("2024-05-01", "2024-09-01"), _feature_rows("2024-07-01", None)])
FEATURE_COLUMNS = ("customer_id, feature_name, feature_value, feature_type, CAST(computed_at AS VARCHAR) AS computed_at,"
                   " CAST(expires_at AS VARCHAR) AS expires_at")
LATEST = """SELECT * FROM history WHERE computed_at <= TIMESTAMP '2024-06-01' AND (expires_at IS NULL OR expires_at > TIMESTAMP '2024-06-01')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id, feature_name ORDER BY computed_at DESC) = 1"""

PREDICTIONS = " UNION ALL ".join(
    f"SELECT ingest_seq * 10 + {2 * i + t} AS prediction_id, customer_id, '{m}' AS model_name, {c}{' / 2' if t == 0 else ''} AS churn_probability,"
    f" CASE WHEN {c}{' / 2' if t == 0 else ''} >= 0.5 THEN 1 ELSE 0 END AS predicted_churn, TIMESTAMP '2024-0{t + 1}-01 00:00:00' AS prediction_date FROM scored"
    for i, (m, c) in enumerate(SCORE_COLUMNS.items()) for t in (0, 1))
LAST_PREDICTIONS = """SELECT * FROM predictions
  QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id, model_name ORDER BY prediction_date DESC, prediction_id DESC) = 1"""

_TALL = " UNION ALL ".join(f"SELECT region_no, label, '{m}' AS model_name, {c} AS score FROM scored" for m, c in SCORE_COLUMNS.items())
PERFORMANCE = f"""
SELECT CONCAT('run-', CAST(region_no AS VARCHAR)) AS run_id, model_name, region_no AS training_date,
  CASE WHEN region_no % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
  (tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE) AS accuracy,
  (COALESCE(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0) + COALESCE(tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE), 0)) / 2 AS roc_auc,
  tp + fp + tn + fn AS test_size
FROM (SELECT region_no, model_name, COUNT(*) FILTER (score >= 0.5 AND label = 1) AS tp,
        COUNT(*) FILTER (score >= 0.5 AND label = 0) AS fp, COUNT(*) FILTER (score < 0.5 AND label = 0) AS tn,
        COUNT(*) FILTER (score < 0.5 AND label = 1) AS fn FROM ({_TALL}) GROUP BY 1, 2)
"""
EXPORTED = """
SELECT * FROM (SELECT p.*, MAX(accuracy) OVER (PARTITION BY run_id) AS best FROM performance p)
QUALIFY ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY
  CASE WHEN accuracy < best - 0.03::DOUBLE THEN 9 WHEN model_name = 'XGBoost' THEN 1 WHEN model_name = 'LightGBM' THEN 2
       WHEN model_name = 'Gradient Boosting' THEN 3 WHEN model_name = 'Random Forest' THEN 4 ELSE 9 END,
  accuracy DESC, roc_auc DESC, model_name) = 1
"""

CURVE = """
SELECT score, pos, neg, CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(neg) OVER w AS BIGINT) AS fp,
  CAST(SUM(pos) OVER () AS BIGINT) AS p, CAST(SUM(neg) OVER () AS BIGINT) AS n
FROM (SELECT {c} AS score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1)
WINDOW w AS (ORDER BY score DESC)
"""
AUC = "CAST(SUM(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE))"


def _sweep(c: str) -> str:
    return (f"SELECT t / 100.0::DOUBLE AS threshold, COUNT(*) FILTER (CASE WHEN {c} >= t / 100.0::DOUBLE THEN 1 ELSE 0 END = label)"
            f" / CAST(COUNT(*) AS DOUBLE) AS accuracy FROM scored, RANGE(20, 96) AS r(t) GROUP BY t")


SEGMENTED = f"""
SELECT customer_id, label AS "Actual", CASE WHEN score >= {{t}} THEN 1 ELSE 0 END AS "Predicted",
  {_half_up("score", 4)} AS "Churn_Probability",
  CASE WHEN score >= p85 THEN 'High Risk' WHEN score >= p70 THEN 'Med-High Risk' WHEN score >= p50 THEN 'Med-Low Risk'
       ELSE 'Low Risk' END AS "Risk_Segment"
FROM scored, (SELECT QUANTILE_CONT(score, 0.85) AS p85, QUANTILE_CONT(score, 0.70) AS p70, QUANTILE_CONT(score, 0.50) AS p50 FROM scored)
"""

_CTES = [
    ("raw", RAW), ("renamed", RENAMED), ("customers", CUSTOMERS), ("billing", BILLING), ("tiled", TILED),
    ("scored", SCORED), ("history", FEATURE_HISTORY), ("latest", LATEST), ("predictions", PREDICTIONS),
    ("last_predictions", LAST_PREDICTIONS), ("performance", PERFORMANCE), ("exported", EXPORTED),
    ("curve", CURVE.format(c="score")),
]
_NEEDS = {
    "renamed": ["raw"], "customers": ["renamed"], "billing": ["customers"], "tiled": ["billing"],
    "scored": ["customers"], "history": ["customers"], "latest": ["history"], "predictions": ["scored"],
    "last_predictions": ["predictions"], "performance": ["scored"], "exported": ["performance"], "curve": ["scored"],
}


def _with(select: str, *needs: str, extra: str = "") -> str:
    wanted, todo = set(), list(needs)
    while todo:
        one = todo.pop()
        wanted.add(one)
        todo += _NEEDS.get(one, [])
    parts = [f"{n} AS ({text})" for n, text in _CTES if n in wanted]
    return "WITH " + ", ".join(parts) + (", " + extra if extra else "") + " " + select


def _null_counts() -> str:
    names = ["ingest_seq", "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure", "phone_service",
             "multiple_lines", "internet_service", "online_security", "online_backup", "device_protection", "tech_support",
             "streaming_tv", "streaming_movies", "contract", "paperless_billing", "payment_method", "monthly_charges",
             "total_charges", "churn", "region_no"]
    return " UNION ALL ".join(f"SELECT '{c}' AS c, COUNT(*) FILTER ({c} IS NULL) AS n FROM customers" for c in names)


def _rules(table: str) -> str:
    rules = {}
    for c, values in schema.ALLOWED_VALUES.items():
        rules[f"{c}_allowed"] = f"{c} IN ({', '.join(repr(v) for v in values)})"
    for c, text in schema.CUSTOMER_LIMITS.items():
        rules[f"{c}_limit"] = text
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, COUNT(*) FILTER (NOT ({r})) AS violations FROM {table}" for n, r in rules.items())


_OUTLIER = """(SELECT COUNT(*) FILTER (monthly_charges < q1 - 1.5::DOUBLE * (q3 - q1) OR monthly_charges > q3 + 1.5::DOUBLE * (q3 - q1)) FROM customers,
  (SELECT QUANTILE_CONT(monthly_charges, 0.25) AS q1, QUANTILE_CONT(monthly_charges, 0.75) AS q3 FROM customers))"""
_ZERO = "COUNT(*) FILTER (tenure = 0 AND total_charges > 0)"
_CENTS = "CAST(ROUND({} * 100) AS BIGINT)"
_DISCREPANCY = (f"COUNT(*) FILTER (tenure > 6 AND 2 * ABS({_CENTS.format('monthly_charges')} * tenure - {_CENTS.format('total_charges')})"
                f" > {_CENTS.format('monthly_charges')} * tenure)")

_RFM_TRANSACTIONS = """
SELECT *, recency_ntile + frequency_ntile + monetary_ntile AS rfm_score FROM (
  SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_months DESC, customer_id) AS INT) AS recency_ntile,
    CAST(NTILE(5) OVER (ORDER BY frequency_txn, customer_id) AS INT) AS frequency_ntile,
    CAST(NTILE(5) OVER (ORDER BY monetary_cents, customer_id) AS INT) AS monetary_ntile
  FROM (SELECT {who} AS customer_id, (SELECT MAX(YEAR({at}) * 12 + MONTH({at})) FROM {table}) - MAX(YEAR({at}) * 12 + MONTH({at})) AS recency_months,
          COUNT(*) AS frequency_txn, CAST(SUM(CAST(ROUND({amount} * 100) AS BIGINT)) AS BIGINT) AS monetary_cents
        FROM {table} GROUP BY 1) a) b
"""


def _analytics() -> str:
    parts = []
    for kind in ("contract", "tenure_group", "risk_segment", "payment_method", None):
        value = kind or "'all'"
        parts.append(f"""SELECT '2024-06-01' AS analysis_date, '{kind or 'all'}' AS segment_type, {value} AS segment_value,
          COUNT(*) AS total_customers, COUNT(*) FILTER (churn = 'Yes') AS churned_customers,
          {_half_up("COUNT(*) FILTER (churn = 'Yes') / CAST(COUNT(*) AS DOUBLE)", 4)} AS churn_rate,
          {_half_up(_mean("monthly_charges"), 2)} AS avg_monthly_charges,
          {_half_up(_mean("total_charges"), 2)} AS avg_total_charges, {_half_up(_mean("tenure"), 2)} AS avg_tenure,
          CAST(SUM(CAST(monthly_charges AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
          CAST(COALESCE(SUM(CAST(monthly_charges AS DECIMAL(18, 2))) FILTER (churn = 'Yes'), 0) AS DOUBLE) AS lost_revenue,
          CAST(COALESCE(SUM(CAST(monthly_charges AS DECIMAL(18, 2))) FILTER (churn = 'No' AND risk_segment = 'High Risk'), 0) AS DOUBLE)
            AS retention_opportunity
          FROM (SELECT t.*, {RISK.format('Medium')} AS risk_segment FROM tiled t) {f'GROUP BY {kind}' if kind else ''}""")
    return " UNION ALL ".join(parts)


_RATIO_MEAN = "AVG(tenure_charge_ratio) OVER (PARTITION BY tenure_group)"
_DUPLICATES = "CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT)"


def oracle() -> dict[str, str]:
    cust = lambda select: _with(select, "customers")
    renamed = lambda select: _with(select, "renamed")
    out = {
        "clean_rename": renamed("SELECT * FROM renamed"),
        "clean_total_charges": renamed("SELECT ingest_seq, customer_id, COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), 0) AS total_charges FROM renamed"),
        "impute_total_charges": renamed("SELECT ingest_seq, customer_id, COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), monthly_charges * tenure) AS total_charges FROM renamed"),
        "clean_yes_no": renamed("SELECT ingest_seq, " + ", ".join(
            f"CASE WHEN {c} IN ('Yes', 'No') THEN {c} END AS {c}" for c in ("partner", "dependents", "phone_service", "paperless_billing", "churn")) + " FROM renamed"),
        "clean_int": renamed("SELECT ingest_seq, senior_citizen FROM renamed"),
        "clip_negative": renamed("SELECT ingest_seq, CASE WHEN tenure < 0 THEN 0 ELSE tenure END AS tenure, CASE WHEN monthly_charges < 0 THEN 0 ELSE monthly_charges END AS monthly_charges, GREATEST(COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), 0), 0) AS total_charges FROM renamed"),
        "dedupe_customers": renamed("SELECT customer_id, ingest_seq, payment_method FROM renamed QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ingest_seq) = 1"),
        "tenure_group": renamed("""SELECT ingest_seq,
            CASE WHEN tenure <= 12 THEN '0-12 Months' WHEN tenure <= 24 THEN '13-24 Months' WHEN tenure <= 48 THEN '25-48 Months'
                 WHEN tenure <= 60 THEN '49-60 Months' ELSE '60+ Months' END AS tenure_group,
            CASE WHEN tenure IS NULL OR tenure < 0 THEN 0 WHEN tenure <= 12 THEN 1 WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 3
                 WHEN tenure <= 60 THEN 4 ELSE 5 END AS tenure_bucket FROM renamed"""),
        "clean_customers": cust("SELECT * EXCLUDE (tenure_group) FROM customers"),
        "filter_churned": cust("SELECT customer_id, monthly_charges, tenure FROM customers WHERE churn = 'Yes'"),
        "filter_high_value": cust("SELECT customer_id, churn, contract FROM customers WHERE monthly_charges > 50"),
        "filter_long_tenure": cust("SELECT customer_id, churn, monthly_charges FROM customers WHERE tenure > 24"),
        "filter_unexpired": _with(f"SELECT {FEATURE_COLUMNS} FROM history WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-06-01'", "history"),
        "payment_text_search": cust("SELECT customer_id, payment_method FROM customers WHERE LOWER(payment_method) SIMILAR TO '.*\\bautomatic\\b.*' AND LOWER(payment_method) SIMILAR TO '.*\\bbank\\b.*'"),
        "customer_summary": cust(f"SELECT customer_id, gender, senior_citizen, partner, dependents, tenure, tenure_group, contract, payment_method, monthly_charges, total_charges, churn, {SERVICES_SUMMARY} AS total_services FROM customers"),
        "billing_features": _with("SELECT customer_id, avg_monthly_spend, is_new_customer, tenure_charge_ratio, charge_per_tenure_plus1, service_intensity, senior_and_new, electronic_check_flag, auto_pay_flag, partner_dependents_flag, multi_services FROM billing", "billing"),
        "service_counts": cust(f"SELECT customer_id, {SERVICES_SQL} AS services_sql, {SERVICES_PANDAS} AS services_pandas, {SERVICES_SUMMARY} AS services_summary FROM customers"),
        "ntile_global": _with("SELECT customer_id, recency_ntile, frequency_ntile, monetary_ntile FROM tiled", "tiled"),
        "cohort_benchmarks": _with(f"""SELECT customer_id, {_mean("total_charges", " OVER (PARTITION BY contract)")} AS avg_totalcharges_by_contract,
            {_mean("multi_services", " OVER (PARTITION BY contract)")} AS avg_services_by_contract,
            {_mean("monthly_charges", " OVER (PARTITION BY tenure_group)")} AS avg_monthly_by_tenure_group,
            {_half_up(_RATIO_MEAN, 6)} AS avg_tenure_charge_ratio_by_group FROM billing""", "billing"),
        "lag_in_cohort": cust(f"SELECT customer_id, {LAG.format('total_charges')} AS prev_total, {LAG.format('monthly_charges')} AS prev_monthly FROM customers"),
        "rfm_base": cust("SELECT customer_id, tenure AS recency_months, 1 AS frequency_txn, total_charges AS monetary_value FROM customers"),
        "rfm_score": _with("SELECT customer_id, rfm_score FROM tiled", "tiled"),
        "risk_segment": _with(f"SELECT customer_id, {RISK.format('Medium')} AS risk_segment FROM tiled", "tiled"),
        "enhanced_risk_segment": _with(f"SELECT customer_id, {ENHANCED_RISK} AS enhanced_risk_segment FROM tiled", "tiled"),
        "rfm_features": _with(f"""SELECT customer_id, tenure AS recency_months, 1 AS frequency_txn, total_charges AS monetary_value, monthly_charges,
            contract, tenure_group, churn, recency_ntile, frequency_ntile, monetary_ntile, rfm_score, {RISK.format('Med')} AS risk_segment,
            {_mean("total_charges", " OVER (PARTITION BY contract)")} AS avg_totalcharges_by_contract,
            {_mean("monthly_charges", " OVER (PARTITION BY tenure_group)")} AS avg_monthly_by_tenure_group,
            {LAG.format('total_charges')} AS prev_monetary_same_contract FROM tiled""", "tiled"),
        "enhanced_features": _with(f"""SELECT customer_id, tenure AS recency_months, 1 AS frequency_txn, total_charges AS monetary_value, monthly_charges,
            contract, tenure_group, churn, avg_monthly_spend, is_new_customer, tenure_charge_ratio, charge_per_tenure_plus1, service_intensity,
            electronic_check_flag, auto_pay_flag, partner_dependents_flag, senior_and_new, multi_services, recency_ntile, frequency_ntile,
            monetary_ntile, rfm_score, {RISK.format('Medium')} AS risk_segment, {ENHANCED_RISK} AS enhanced_risk_segment,
            {_mean("total_charges", " OVER (PARTITION BY contract)")} AS avg_totalcharges_by_contract,
            {_mean("monthly_charges", " OVER (PARTITION BY tenure_group)")} AS avg_monthly_by_tenure_group,
            {_mean("multi_services", " OVER (PARTITION BY contract)")} AS avg_services_by_contract,
            {_half_up(_RATIO_MEAN, 6)} AS avg_tenure_charge_ratio_by_group,
            {LAG.format('total_charges')} AS prev_monetary_same_contract, {LAG.format('monthly_charges')} AS prev_monthly_same_contract,
            '2024-06-01 00:00:00' AS feature_computed_at FROM tiled""", "tiled"),
        "rfm_from_orders": _RFM_TRANSACTIONS.format(who="o_custkey", at="o_orderdate", amount="o_totalprice", table="orders"),
        "rfm_from_events": _RFM_TRANSACTIONS.format(who="user_id", at="ts", amount="value", table="events"),
        "churn_distribution": cust("""SELECT c AS churn, COALESCE(n, 0) AS customers, (SELECT COUNT(*) FILTER (churn = 'Yes') * 100 / CAST(COUNT(*) FILTER (churn IN ('Yes', 'No')) AS DOUBLE) FROM customers) AS churn_rate_pct
            FROM (VALUES ('No'), ('Yes')) v(c) LEFT JOIN (SELECT churn, COUNT(*) AS n FROM customers GROUP BY churn) g ON g.churn = v.c"""),
        "churn_rate_by_contract": cust("SELECT contract, COUNT(*) FILTER (churn = 'Yes') * 100 / CAST(COUNT(*) AS DOUBLE) AS churn_rate_pct FROM customers WHERE contract IS NOT NULL GROUP BY contract"),
        "pivot_churn_by_contract": cust("""SELECT contract, COUNT(*) FILTER (churn = 'No') AS "No", COUNT(*) FILTER (churn = 'Yes') AS "Yes",
            COUNT(*) FILTER (churn = 'Yes') / CAST(COUNT(*) FILTER (churn IN ('Yes', 'No')) AS DOUBLE) AS churn_rate FROM customers WHERE contract IS NOT NULL GROUP BY contract"""),
        "cohort_churn_analysis": cust(f"""SELECT tenure_group, COUNT(customer_id) AS "Total_Customers", COUNT(*) FILTER (churn = 'Yes') AS "Churned",
            COUNT(customer_id) - COUNT(*) FILTER (churn = 'Yes') AS "Retained",
            {_half_up("COUNT(*) FILTER (churn = 'Yes') * 100 / CAST(COUNT(customer_id) AS DOUBLE)", 2)} AS "Churn_Rate_Pct"
            FROM customers WHERE tenure IS NOT NULL GROUP BY tenure_group"""),
        "risk_scorecard": _with(f"""SELECT "Risk_Segment", COUNT(*) AS "Customer_Count",
            {_half_up('CAST(SUM(CAST("Churn_Probability" AS DECIMAL(18, 4))) AS DOUBLE) / COUNT(*)', 4)} AS "Avg_Churn_Prob",
            {_half_up('SUM("Actual") / CAST(COUNT(*) AS DOUBLE)', 4)} AS "Actual_Churn_Rate" FROM ({SEGMENTED.format(t=0.5)}) GROUP BY 1""", "scored"),
        "confusion_matrix": _with("""SELECT CASE WHEN label = 1 THEN 'Churn' ELSE 'No Churn' END AS "Actual", COUNT(*) FILTER (score >= 0.48::DOUBLE) AS "Churn",
            COUNT(*) FILTER (score < 0.48::DOUBLE) AS "No Churn" FROM scored GROUP BY 1""", "scored"),
        "roi_calculator": _with("""SELECT CONCAT(CAST(r AS VARCHAR), '%') AS "Retention_Rate", h AS "High_Risk_Customers", 64.76::DOUBLE AS "Avg_Monthly_Revenue_USD",
            FLOOR((h * 6476 * r + 50) / 100) / 100.0::DOUBLE AS "Monthly_Saved_USD", FLOOR((h * 6476 * r + 50) / 100) * 12 / 100.0::DOUBLE AS "Annual_Saved_USD"
            FROM (SELECT COUNT(*) FILTER (score >= (SELECT QUANTILE_CONT(score, 0.85) FROM scored)) AS h FROM scored), (VALUES (20), (30), (40), (50)) v(r)""", "scored"),
        "correlation_matrix": cust(" UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_half_up(f'CORR({a}, {b})', 6)} AS correlation FROM customers"
            for a in ("tenure", "monthly_charges", "total_charges") for b in ("tenure", "monthly_charges", "total_charges"))),
        "quantiles": cust(" UNION ALL ".join(
            f"SELECT {q}::DOUBLE AS probability, QUANTILE_CONT(monthly_charges, {q}) AS value FROM customers" for q in (0.25, 0.5, 0.7, 0.75, 0.85))),
        "boxplot_stats": cust("""SELECT c.churn, ANY_VALUE(q1) AS q1, ANY_VALUE(median) AS median, ANY_VALUE(q3) AS q3,
            MIN(monthly_charges) FILTER (monthly_charges >= q1 - 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
            MAX(monthly_charges) FILTER (monthly_charges <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
            COUNT(*) FILTER (monthly_charges < q1 - 1.5::DOUBLE * (q3 - q1) OR monthly_charges > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
            FROM customers c JOIN (SELECT churn, QUANTILE_CONT(monthly_charges, 0.25) AS q1, QUANTILE_CONT(monthly_charges, 0.5) AS median,
              QUANTILE_CONT(monthly_charges, 0.75) AS q3 FROM customers GROUP BY churn) q ON q.churn = c.churn GROUP BY c.churn"""),
        "numeric_summary": cust(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, {_mean(c)} AS mean_value,"
            f" QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5) AS median_value, {'COUNT(*) FILTER (tenure = 0)' if c == 'tenure' else 'CAST(NULL AS BIGINT)'} AS zero_count FROM customers"
            for c in ("tenure", "monthly_charges", "total_charges"))),
        "churn_analytics": _with(_analytics(), "tiled"),
        "dq_null_counts": cust(f"SELECT c AS column_name, n AS null_count FROM ({_null_counts()}) WHERE n > 0"),
        "dq_duplicates": renamed(f"SELECT {_DUPLICATES} AS duplicate_rows FROM renamed"),
        "dq_outliers_iqr": cust(f"SELECT {_OUTLIER} AS outlier_count, COUNT(*) AS total_records FROM customers"),
        "dq_zero_tenure_charged": cust(f"SELECT {_ZERO} AS zero_tenure_charged FROM customers"),
        "dq_billing_discrepancy": cust(f"SELECT {_DISCREPANCY} AS billing_discrepancy FROM customers"),
        "dq_report": cust(f"""SELECT 'customers' AS table_name, check_name, CASE WHEN n = 0 THEN 'PASS' WHEN kind = 'w' THEN 'WARNING' ELSE 'FAIL' END AS check_result,
            n AS error_count, (SELECT COUNT(*) FROM customers) AS total_records,
            CASE WHEN n > 0 THEN CONCAT('Found ', CAST(n AS VARCHAR), ' rows: ', check_name) END AS error_details, '2024-06-01 00:00:00' AS checked_at
            FROM (SELECT 'w' AS kind, CONCAT('nulls_', c) AS check_name, n FROM ({_null_counts()})
              UNION ALL SELECT 'w', 'outliers_monthly_charges', {_OUTLIER}
              UNION ALL SELECT 'f', 'zero_tenure_charged', {_ZERO} FROM customers
              UNION ALL SELECT 'f', 'billing_discrepancy', {_DISCREPANCY} FROM customers
              UNION ALL SELECT 'f', 'duplicate_keys', {_DUPLICATES} FROM customers
              UNION ALL SELECT 'f', CONCAT('rule_', rule), violations FROM ({_rules('customers')}))"""),
        "dq_constraints": _with(f"""SELECT 'customers' AS table_name, rule, violations FROM ({_rules('checked')})
            UNION ALL SELECT 'predictions', 'churn_probability_limit', COUNT(*) FILTER (NOT (churn_probability BETWEEN 0 AND 1)) FROM predictions
            UNION ALL SELECT 'predictions', 'predicted_churn_limit', COUNT(*) FILTER (NOT (predicted_churn IN (0, 1))) FROM predictions""", "predictions",
            extra="checked AS (SELECT * REPLACE (COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), 0) AS total_charges) FROM renamed)"),
        "dq_primary_key": renamed("SELECT customer_id, COUNT(*) AS row_count, CASE WHEN customer_id IS NULL THEN 'null' ELSE 'duplicate' END AS reason FROM renamed GROUP BY customer_id HAVING COUNT(*) > 1 OR customer_id IS NULL"),
        "dq_foreign_key": _with(f"SELECT {FEATURE_COLUMNS} FROM history WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE churn = 'No')", "history"),
        "cascade_delete": _with(f"SELECT {FEATURE_COLUMNS} FROM history WHERE customer_id IN (SELECT customer_id FROM customers WHERE churn = 'No')", "history"),
        "feature_store_write": cust(f"SELECT {FEATURE_COLUMNS} FROM ({_feature_rows('2024-01-01', '2024-03-01')})"),
        "feature_store_latest": _with("SELECT customer_id, feature_name, feature_value, feature_type, CAST(computed_at AS VARCHAR) AS computed_at FROM latest", "latest"),
        "feature_store_wide": _with("SELECT customer_id, " + ", ".join(
            f"MAX(feature_value) FILTER (feature_name = '{f}') AS {f}" for f in ("tenure", "monthly_charges", "total_charges", "senior_citizen")) + " FROM latest GROUP BY 1", "latest"),
        "predictions_latest": _with("SELECT * REPLACE (CAST(prediction_date AS VARCHAR) AS prediction_date) FROM last_predictions", "last_predictions"),
        "top_risk_customers": _with("SELECT customer_id, churn_probability FROM last_predictions WHERE model_name = 'XGBoost' ORDER BY churn_probability DESC, customer_id LIMIT 50", "last_predictions"),
        "model_leaderboard": _with("SELECT run_id, model_name, accuracy, roc_auc, CAST(ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY accuracy DESC, roc_auc DESC, model_name) AS INT) AS leaderboard_rank FROM performance", "performance"),
        "model_latest_version": _with("SELECT model_name, model_version, run_id, accuracy FROM performance QUALIFY ROW_NUMBER() OVER (PARTITION BY model_name, model_version ORDER BY training_date DESC, run_id DESC) = 1", "performance"),
        "hyperparameters_json": _with("""SELECT run_id, model_name, CONCAT('{"n_estimators":', CAST(test_size AS VARCHAR), ',"solver":"', model_version, '"}') AS hyperparameters,
            test_size AS n_estimators, model_version AS solver FROM performance""", "performance"),
        "upsert_customers": renamed("""SELECT COALESCE(a.customer_id, b.customer_id) AS customer_id,
            CASE WHEN b.customer_id IS NULL THEN a.contract ELSE b.contract END AS contract,
            CASE WHEN b.customer_id IS NULL THEN a.payment_method ELSE b.payment_method END AS payment_method,
            CASE WHEN a.customer_id IS NULL THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS created_at,
            CASE WHEN a.customer_id IS NULL OR (b.customer_id IS NOT NULL AND (a.contract IS DISTINCT FROM b.contract OR a.payment_method IS DISTINCT FROM b.payment_method))
                 THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS updated_at
            FROM (SELECT * FROM (SELECT * FROM renamed QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ingest_seq) = 1) WHERE contract IS NOT NULL) a
            FULL JOIN (SELECT * FROM (SELECT * FROM renamed QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ingest_seq DESC) = 1) WHERE tenure IS NOT NULL) b
            ON a.customer_id = b.customer_id"""),
        "stratified_split": cust("""SELECT customer_id, churn, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY MD5(CONCAT('42|', customer_id)), customer_id)
            <= FLOOR(0.8::DOUBLE * COUNT(*) OVER (PARTITION BY churn) + 0.5) AS is_train FROM customers"""),
        "stratified_folds": cust("SELECT customer_id, churn, CAST((ROW_NUMBER() OVER (PARTITION BY churn ORDER BY MD5(CONCAT('42|', customer_id)), customer_id) - 1) % 5 AS INT) AS fold FROM customers"),
        "threshold_sweep": _with(_sweep("score"), "scored"),
        "best_threshold": _with(f"SELECT * FROM ({_sweep('score')}) ORDER BY accuracy DESC, threshold LIMIT 1", "scored"),
        "binary_metrics": _with("""SELECT tp, fp, tn, fn, (tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE) AS accuracy,
            COALESCE(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0) AS precision, COALESCE(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0) AS recall,
            COALESCE(2 * tp / CAST(NULLIF(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS f1_score
            FROM (SELECT COUNT(*) FILTER (score >= 0.48::DOUBLE AND label = 1) AS tp, COUNT(*) FILTER (score >= 0.48::DOUBLE AND label = 0) AS fp,
              COUNT(*) FILTER (score < 0.48::DOUBLE AND label = 0) AS tn, COUNT(*) FILTER (score < 0.48::DOUBLE AND label = 1) AS fn FROM scored)""", "scored"),
        "roc_curve": _with("SELECT score AS threshold, fp / CAST(n AS DOUBLE) AS fpr, tp / CAST(p AS DOUBLE) AS tpr FROM curve", "curve"),
        "auc": _with(f"SELECT {AUC} AS roc_auc FROM curve", "curve"),
        "precision_recall_curve": _with("SELECT score AS threshold, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(p AS DOUBLE) AS recall FROM curve", "curve"),
        "select_export_model": _with("SELECT run_id, model_name, accuracy, roc_auc FROM exported", "exported"),
        "target_gate": _with("SELECT run_id, model_name, accuracy >= 0.82::DOUBLE AND roc_auc > 0.85::DOUBLE AS target_met FROM exported", "exported"),
        "score_and_segment": _with(f"""SELECT *, CASE WHEN "Actual" = 1 THEN 'Churn' ELSE 'No Churn' END AS "Actual_Label",
            CASE WHEN "Predicted" = 1 THEN 'Churn' ELSE 'No Churn' END AS "Predicted_Label", "Actual" = "Predicted" AS "Correct" FROM ({SEGMENTED.format(t='0.48::DOUBLE')})""", "scored"),
        "load_customers": renamed("SELECT customer_id, tenure, contract, monthly_charges, COALESCE(TRY_CAST(NULLIF(TRIM(total_charges), '') AS DOUBLE), 0) AS total_charges, churn FROM renamed"),
        "load_or_fallback": renamed("SELECT contract, COUNT(*) AS customers FROM renamed GROUP BY contract"),
        "write_table": cust("SELECT churn, 2 * COUNT(*) AS row_count FROM customers GROUP BY churn"),
        "reload_table": cust("SELECT customer_id, contract, churn FROM customers"),
        "export_csv": cust("""SELECT tenure_group, COUNT(customer_id) AS total_customers, COUNT(*) FILTER (churn = 'Yes') AS churned
            FROM customers WHERE tenure IS NOT NULL GROUP BY tenure_group"""),
        "run_sql": cust("SELECT contract, COUNT(*) AS customers, CAST(SUM(CAST(monthly_charges AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM customers WHERE tenure >= 12 GROUP BY contract"),
    }
    high = "(SELECT QUANTILE_CONT(monthly_charges, 0.7) FROM customers)"
    guarded = lambda *cs: " AND ".join(f"COALESCE({c} IN ('No', 'No internet service'), FALSE)" for c in cs)
    out["customer_features"] = _with(f"""
        SELECT f.*, contract_mtm * is_new_customer AS mtm_new_customer, fiber_optic_flag * no_protection AS fiber_no_protect,
          electronic_check_flag * contract_mtm AS echeck_mtm FROM (
        SELECT customer_id, tenure_group, {_flag("churn = 'Yes'")} AS churned, senior_citizen, tenure, monthly_charges, total_charges,
          avg_monthly_spend, is_new_customer, tenure_charge_ratio, charge_per_tenure_plus1, service_intensity, senior_and_new,
          electronic_check_flag, auto_pay_flag, partner_dependents_flag, services_pandas AS multi_services,
          {_flag("contract = 'Month-to-month'")} AS contract_mtm, {_flag("internet_service = 'Fiber optic'")} AS fiber_optic_flag,
          {_flag("internet_service IS DISTINCT FROM 'No' AND " + guarded('online_security', 'online_backup', 'tech_support'))} AS no_protection,
          {_flag("(streaming_tv = 'Yes' OR streaming_movies = 'Yes') AND " + guarded('online_security', 'tech_support'))} AS streaming_no_protect,
          {_flag(f"monthly_charges > {high}")} AS high_monthly_charges, services_pandas * tenure AS services_x_tenure,
          CASE WHEN contract IS NOT NULL THEN monthly_charges / ({_mean("monthly_charges", " OVER (PARTITION BY contract)")} + 1) END AS charge_vs_contract_avg,
          CASE WHEN tenure IS NULL THEN 0 WHEN tenure <= 12 THEN 1 WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 3 WHEN tenure <= 60 THEN 4 ELSE 5 END AS tenure_bucket_num,
          CAST(tenure AS BIGINT) * tenure AS tenure_sq, monthly_charges * tenure AS charges_x_tenure FROM billing) f""", "billing")
    ranked = " UNION ALL ".join(
        f"SELECT {i} AS i, '{c}' AS m, MAX(accuracy) AS a FROM ({_sweep(c)})" for i, c in enumerate(SCORE_COLUMNS.values()))
    areas = " UNION ALL ".join(
        f"SELECT '{c}' AS m, {AUC} AS w FROM ({CURVE.format(c=c)})" for c in SCORE_COLUMNS.values())
    tall = " UNION ALL ".join(f"SELECT customer_id, '{c}' AS m, {c} AS s FROM scored" for c in SCORE_COLUMNS.values())
    voted = "SUM(t.s * w) / SUM(w)"
    out["soft_vote"] = _with(f"""SELECT customer_id, {_half_up(voted, 6)} AS ensemble FROM ({tall}) t
        JOIN (SELECT m FROM ({ranked}) ORDER BY a DESC, i LIMIT 3) USING (m) JOIN ({areas}) USING (m) GROUP BY customer_id""", "scored")
    dummies = {
        "contract": ["One year", "Two year"],
        "payment_method": ["Credit card (automatic)", "Electronic check", "Mailed check"],
        "internet_service": ["Fiber optic", "No"], "multiple_lines": ["No phone service", "Yes"],
        "tenure_group": ["13-24 Months", "25-48 Months", "49-60 Months", "60+ Months"],
    }
    coded = ", ".join(f"""{_flag(f"{c} = '{v}'")} AS "{c}_{v}\"""" for c, vs in dummies.items() for v in vs)
    out["one_hot_sparse"] = _with("""SELECT customer_id, COALESCE(STRING_AGG(CAST(slot AS VARCHAR), ',' ORDER BY slot), '') AS slots,
          (SELECT COUNT(*) FROM slotted) AS width FROM long LEFT JOIN slotted USING (column_no, category) GROUP BY customer_id""",
          "customers", extra="""long AS (SELECT customer_id, 0 AS column_no, contract AS category FROM customers
          UNION ALL SELECT customer_id, 1, payment_method FROM customers UNION ALL SELECT customer_id, 2, customer_id FROM customers),
          placed AS (SELECT column_no, category, ROW_NUMBER() OVER (PARTITION BY column_no ORDER BY category) AS place
          FROM (SELECT DISTINCT column_no, category FROM long WHERE category IS NOT NULL)),
          slotted AS (SELECT column_no, category, ROW_NUMBER() OVER (ORDER BY column_no, category) - 1 AS slot FROM placed WHERE place > 1)""")
    out["one_hot"] = cust(f"""SELECT customer_id, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY MD5(CONCAT('42|', customer_id)), customer_id)
        <= FLOOR(0.8::DOUBLE * COUNT(*) OVER (PARTITION BY churn) + 0.5) AS is_train, {coded} FROM customers""")
    out["smote"] = cust("""SELECT label, synthetic, n AS rows FROM (
        SELECT label, FALSE AS synthetic, n FROM sizes UNION ALL
        SELECT label, TRUE, (SELECT MAX(n) - MIN(n) FROM sizes) FROM sizes WHERE n = (SELECT MIN(n) FROM sizes))""").replace(
        " SELECT label, synthetic", """, sizes AS (SELECT CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label,
        CAST(FLOOR(0.8::DOUBLE * COUNT(*) + 0.5) AS BIGINT) AS n FROM customers GROUP BY 1) SELECT label, synthetic""", 1)
    tested = """FROM (SELECT customer_id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label, ROW_NUMBER() OVER (PARTITION BY coalesce(churn, 'No')
        ORDER BY MD5(CONCAT('42|', customer_id)), customer_id) > FLOOR(0.8::DOUBLE * COUNT(*) OVER (PARTITION BY coalesce(churn, 'No')) + 0.5) AS tested
        FROM customers) WHERE tested"""
    names = ["Logistic Regression", "Random Forest", "Gradient Boosting", "Weighted GBT", "Column-Sampled GBT"]
    out["model_checks"] = cust(f"""SELECT model_name, test_rows, test_churned, TRUE AS accuracy_follows, TRUE AS scores_are_probabilities,
        TRUE AS better_than_chance FROM (SELECT COUNT(*) AS test_rows, SUM(label)::BIGINT AS test_churned {tested}), (SELECT UNNEST({names}) AS model_name)""")
    out["explanation_checks"] = cust(f"SELECT customer_id, TRUE AS adds_up, TRUE AS in_order, TRUE AS importances_add_up {tested}")
    out["resumed_model"] = cust(f"SELECT customer_id, label, TRUE AS same_score {tested}")
    out["smote_uses"] = cust("""SELECT uses, customers, TRUE AS within_ranges FROM (
        SELECT m.n AS few, f.n - m.n AS needed FROM (SELECT CAST(FLOOR(0.8::DOUBLE * COUNT(*) + 0.5) AS BIGINT) AS n FROM customers WHERE churn = 'Yes') m,
          (SELECT CAST(FLOOR(0.8::DOUBLE * COUNT(*) + 0.5) AS BIGINT) AS n FROM customers WHERE churn IS DISTINCT FROM 'Yes') f),
        LATERAL (SELECT needed // few AS uses, few - needed % few AS customers UNION ALL SELECT needed // few + 1, needed % few)
        WHERE uses > 0 AND customers > 0""")
    out["run_history"] = _with("""SELECT run_id, model_name, accuracy, test_size, CONCAT('202406', LPAD(CAST(CAST(SUBSTR(run_id, 5) AS INT) + 1 AS VARCHAR), 2, '0'), '.000000') AS model_version,
        CAST(ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY accuracy DESC, roc_auc DESC, model_name) AS INT) AS leaderboard_rank FROM performance""", "performance")
    return out
