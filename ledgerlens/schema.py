"""Fixed schemas of the transaction tables (S1) and DDL rendering."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

# Ids are 64-bit: a 100 TB table holds more than 2^31 transactions.
RAW_SCHEMA = StructType([
    StructField("transaction_id", LongType(), True),
    StructField("customer_id", LongType(), True),
    StructField("account_type", StringType(), True),
    StructField("country", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("currency", StringType(), True),
    StructField("category", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("status", StringType(), True),
    StructField("merchant_id", StringType(), True),
    StructField("card_last4", StringType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Rows missing any of these are dropped by the clean step (V9).
CRITICAL_FIELDS = ["transaction_id", "customer_id", "amount", "timestamp", "status"]

FEATURE_FIELDS = [
    StructField("timestamp_dt", TimestampType(), True),
    StructField("hour", IntegerType(), True),
    StructField("day_of_week", IntegerType(), True),
    StructField("time_slot", StringType(), True),
    StructField("is_weekend", BooleanType(), True),
    StructField("amount_category", StringType(), True),
    StructField("minutes_since_last_transaction", DoubleType(), True),
    StructField("customer_transaction_count", LongType(), True),
    StructField("transaction_velocity", StringType(), True),
    StructField("is_suspicious_night", BooleanType(), True),
    StructField("is_suspicious_velocity", BooleanType(), True),
    StructField("risk_score", IntegerType(), True),
]

PARTITION_COLUMNS = ["year", "month", "day"]

PARTITION_FIELDS = [StructField(c, IntegerType(), True) for c in PARTITION_COLUMNS]

# Processed table: raw 12 + 12 features, then the partition columns last,
# which is the column order of a partition-discovered read.
PROCESSED_SCHEMA = StructType(RAW_SCHEMA.fields + FEATURE_FIELDS + PARTITION_FIELDS)
PROCESSED_COLUMNS = [f.name for f in PROCESSED_SCHEMA.fields]

RULE_FIELDS = [
    StructField("fraud_rule_status", BooleanType(), True),
    StructField("fraud_rule_high_declined", BooleanType(), True),
    StructField("fraud_rule_night", BooleanType(), True),
    StructField("fraud_rule_velocity", BooleanType(), True),
    StructField("is_fraud_detected", BooleanType(), True),
    StructField("alert_priority", StringType(), True),
    StructField("fraud_reasons", StringType(), True),
]


# Columns of the alerts external table, in its DDL order (18 of 34).
ALERT_TABLE_COLUMNS = [
    "transaction_id", "customer_id", "account_type", "country", "amount",
    "currency", "category", "channel", "timestamp", "status", "alert_priority",
    "risk_score", "fraud_reasons", "fraud_rule_status", "fraud_rule_high_declined",
    "fraud_rule_night", "fraud_rule_velocity", "is_fraud_detected",
]

# Columns of the alert CSV export (12).
ALERT_CSV_COLUMNS = [
    "transaction_id", "customer_id", "account_type", "country", "amount",
    "currency", "category", "timestamp", "status", "alert_priority",
    "risk_score", "fraud_reasons",
]


def column_ddl(schema: StructType, exclude: tuple[str, ...] = ()) -> str:
    """``name TYPE, ...`` rendered from a schema."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString().upper()}"
        for f in schema.fields if f.name not in exclude
    )
