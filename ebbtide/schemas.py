"""Table schemas, column lists and allowed domains."""

from __future__ import annotations

from pyspark.sql import types as T

CHURN_RAW = T.StructType([
    T.StructField("RowNumber", T.LongType()),
    T.StructField("CustomerId", T.LongType()),
    T.StructField("Surname", T.StringType()),
    T.StructField("CreditScore", T.LongType()),
    T.StructField("Geography", T.StringType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.LongType()),
    T.StructField("Tenure", T.LongType()),
    T.StructField("Balance", T.DoubleType()),
    T.StructField("NumOfProducts", T.IntegerType()),
    T.StructField("HasCrCard", T.IntegerType()),
    T.StructField("IsActiveMember", T.IntegerType()),
    T.StructField("EstimatedSalary", T.DoubleType()),
    T.StructField("Exited", T.IntegerType()),
])

# credit_score is a double because a median fill may end in .5
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("credit_score", T.DoubleType()),
    T.StructField("geography", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("tenure", T.LongType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("num_products", T.IntegerType()),
    T.StructField("has_credit_card", T.IntegerType()),
    T.StructField("is_active_member", T.IntegerType()),
    T.StructField("estimated_salary", T.DoubleType()),
    T.StructField("exited", T.IntegerType()),
])
CUSTOMER_COLUMNS = CUSTOMERS.fieldNames()

# What a scoring request carries: the customer without key and outcome.
SCORING = T.StructType([
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("geography", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("num_products", T.IntegerType()),
    T.StructField("has_credit_card", T.IntegerType()),
    T.StructField("is_active_member", T.IntegerType()),
    T.StructField("estimated_salary", T.DoubleType()),
])
SCORING_COLUMNS = SCORING.fieldNames()

PREDICTIONS = T.StructType(
    [T.StructField("prediction_id", T.StringType()), T.StructField("timestamp", T.TimestampType())]
    + SCORING.fields
    + [T.StructField("churn_probability", T.DoubleType()), T.StructField("risk_level", T.StringType())]
)

MODEL_METRICS = T.StructType([
    T.StructField("Model", T.StringType()),
    T.StructField("Accuracy", T.DoubleType()),
    T.StructField("Precision", T.DoubleType()),
    T.StructField("Recall", T.DoubleType()),
    T.StructField("F1-Score", T.DoubleType()),
    T.StructField("ROC-AUC", T.DoubleType()),
])

MODEL_REGISTRY = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("training_date", T.TimestampType()),
    T.StructField("dataset_size", T.LongType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("preprocessor_path", T.StringType()),
    T.StructField("is_active", T.IntegerType()),
])

# Vendor country -> state of the localised data set.
STATE_OF_COUNTRY = {"France": "Maharashtra", "Germany": "Karnataka", "Spain": "Delhi"}

# Money of the raw file is multiplied by this on load.
MONEY_SCALE = 100

# Domains of the customers table; a NULL passes.
DOMAINS = {
    "geography": ["Maharashtra", "Karnataka", "Delhi"],
    "gender": ["Male", "Female"],
    "has_credit_card": [0, 1],
    "is_active_member": [0, 1],
    "exited": [0, 1],
}

# Inclusive ranges of valid records (None = open end).
RANGES = {"age": (18, 100), "balance": (0, None), "credit_score": (300, 850)}

# Raw column -> customers column.
RAW_TO_CUSTOMER = {
    "CustomerId": "customer_id",
    "CreditScore": "credit_score",
    "Geography": "geography",
    "Gender": "gender",
    "Age": "age",
    "Tenure": "tenure",
    "Balance": "balance",
    "NumOfProducts": "num_products",
    "HasCrCard": "has_credit_card",
    "IsActiveMember": "is_active_member",
    "EstimatedSalary": "estimated_salary",
    "Exited": "exited",
}

# A batch header names a column by its raw or its table name, in any letter case.
HEADER_ALIASES = {raw.lower(): name for raw, name in RAW_TO_CUSTOMER.items()} | {c: c for c in CUSTOMER_COLUMNS}
