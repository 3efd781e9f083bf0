"""Table layouts, required columns and table rules."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw file columns in file order.
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]
_RAW_TYPES = {"SeniorCitizen": T.IntegerType(), "tenure": T.IntegerType(), "MonthlyCharges": T.DoubleType()}
RAW_SCHEMA = T.StructType([T.StructField(c, _RAW_TYPES.get(c, T.StringType())) for c in RAW_COLUMNS])

# Columns a raw file must have for training, and a cleaned table must have.
REQUIRED_RAW = [
    "customerID", "Churn", "tenure", "MonthlyCharges", "TotalCharges",
    "Contract", "SeniorCitizen", "PaymentMethod", "Partner", "Dependents",
]
REQUIRED_CLEAN = [
    "customer_id", "churn", "tenure", "monthly_charges", "total_charges",
    "contract", "senior_citizen", "payment_method",
]

# Lower-cased raw names that differ from the table's names.
RENAMES = {
    "customerid": "customer_id",
    "seniorcitizen": "senior_citizen",
    "phoneservice": "phone_service",
    "multiplelines": "multiple_lines",
    "internetservice": "internet_service",
    "onlinesecurity": "online_security",
    "onlinebackup": "online_backup",
    "deviceprotection": "device_protection",
    "techsupport": "tech_support",
    "streamingtv": "streaming_tv",
    "streamingmovies": "streaming_movies",
    "paperlessbilling": "paperless_billing",
    "paymentmethod": "payment_method",
    "monthlycharges": "monthly_charges",
    "totalcharges": "total_charges",
}

MONTHLY_TYPE = "decimal(10,2)"
TOTAL_TYPE = "decimal(12,2)"

YES_NO = ["Yes", "No"]
WITH_INTERNET = ["Yes", "No", "No internet service"]

# Allowed values per customer column (a rule passes where the column is NULL).
ALLOWED_VALUES = {
    "gender": ["Male", "Female", "Other"],
    "senior_citizen": [0, 1],
    "partner": YES_NO,
    "dependents": YES_NO,
    "contract": ["Month-to-month", "One year", "Two year"],
    "paperless_billing": YES_NO,
    "phone_service": YES_NO,
    "multiple_lines": ["Yes", "No", "No phone service"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": WITH_INTERNET,
    "online_backup": WITH_INTERNET,
    "device_protection": WITH_INTERNET,
    "tech_support": WITH_INTERNET,
    "streaming_tv": WITH_INTERNET,
    "streaming_movies": WITH_INTERNET,
    "churn": YES_NO,
}

# Numeric limits as SQL conditions.
CUSTOMER_LIMITS = {
    "tenure": "tenure >= 0",
    "monthly_charges": "monthly_charges > 0",
    "total_charges": "total_charges >= 0",
}
PREDICTION_LIMITS = {
    "churn_probability": "churn_probability BETWEEN 0 AND 1",
    "predicted_churn": "predicted_churn IN (0, 1)",
}
