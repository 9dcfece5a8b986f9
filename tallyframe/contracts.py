"""Schemas of the change streams and tables, and the column contracts between layers."""

from __future__ import annotations

META = "__op string, __source_ts_ms bigint"

# Change-event layouts. Decimals and dates travel as text, row times as epoch micros.
CHANGE_SCHEMAS = {
    "transactions": "transaction_id bigint, user_id bigint, merchant_id int, amount string, currency string, "
    "status string, decision_latency_ms int, installment_count int, created_at bigint, " + META,
    "repayments": "repayment_id bigint, transaction_id bigint, user_id bigint, installment_number int, "
    "amount string, due_date string, paid_at bigint, status string, created_at bigint, updated_at bigint, " + META,
    "users": "user_id bigint, full_name string, email string, phone string, national_id string, "
    "credit_limit string, credit_tier string, kyc_status string, created_at bigint, updated_at bigint, " + META,
    "merchants": "merchant_id int, merchant_name string, merchant_category string, risk_tier string, "
    "commission_rate string, credit_limit string, country string, created_at bigint, updated_at bigint, " + META,
    "installments": "schedule_id bigint, transaction_id bigint, user_id bigint, total_amount string, "
    "installment_count int, installment_amount string, start_date string, end_date string, status string, "
    "created_at bigint, " + META,
    "app_events": "event_id string, user_id string, event_type string, merchant_id string, session_id string, "
    "device_type string, event_data string, created_at string",
    "merchant_sessions": "session_id string, merchant_id string, action string, page string, "
    "duration_seconds int, created_at string",
}

# Column contracts between layers: (column, type, may be NULL).
CONTRACTS = {
    "silver.transactions": [
        ("transaction_id", "bigint", False), ("user_id", "bigint", False), ("merchant_id", "int", False),
        ("amount", "decimal(12,2)", False), ("currency", "string", False), ("status", "string", False),
        ("decision_latency_ms", "int", True), ("installment_count", "int", False),
        ("created_at", "timestamp_ntz", False),
    ],
    "silver.repayments": [
        ("repayment_id", "bigint", False), ("transaction_id", "bigint", False), ("user_id", "bigint", False),
        ("installment_number", "int", False), ("amount", "decimal(12,2)", False), ("due_date", "date", False),
        ("paid_at", "timestamp_ntz", True), ("status", "string", False), ("updated_at", "timestamp_ntz", False),
    ],
    "silver.users": [
        ("user_id", "bigint", False), ("full_name", "string", False), ("email", "string", False),
        ("credit_limit", "decimal(12,2)", False), ("credit_tier", "string", False), ("kyc_status", "string", False),
    ],
    "silver.merchants": [
        ("merchant_id", "int", False), ("merchant_name", "string", False), ("merchant_category", "string", False),
        ("risk_tier", "string", False), ("commission_rate", "decimal(5,4)", False),
        ("credit_limit", "decimal(15,2)", False), ("country", "string", True),
    ],
    "silver.installments": [
        ("schedule_id", "bigint", False), ("transaction_id", "bigint", False), ("user_id", "bigint", False),
        ("total_amount", "decimal(12,2)", False), ("installment_count", "int", False),
        ("start_date", "date", False), ("status", "string", False), ("created_at", "timestamp_ntz", False),
    ],
    "feature_store.user_credit_features": [
        ("user_id", "bigint", False), ("snapshot_ts", "timestamp_ntz", False), ("valid_from", "timestamp_ntz", False),
        ("valid_to", "timestamp_ntz", False), ("feature_version", "string", False),
        ("tx_velocity_7d", "int", False), ("tx_velocity_30d", "int", False),
        ("avg_tx_amount_30d", "decimal(12,2)", False), ("repayment_rate_90d", "double", False),
        ("merchant_diversity_30d", "int", False), ("declined_rate_7d", "double", False),
        ("active_installments", "int", False), ("days_since_first_tx", "int", False),
    ],
}

# Columns every raw table must have.
RAW_COLUMNS = {
    "bronze.transactions": [
        "transaction_id", "user_id", "merchant_id", "amount", "currency", "status", "decision_latency_ms",
        "installment_count", "created_at", "_ingested_at",
    ],
    "bronze.users": [
        "user_id", "full_name", "email", "credit_limit", "credit_tier", "kyc_status", "created_at", "updated_at",
        "_ingested_at",
    ],
    "bronze.merchants": [
        "merchant_id", "merchant_name", "merchant_category", "risk_tier", "commission_rate", "credit_limit",
        "country", "created_at", "updated_at", "_ingested_at",
    ],
    "bronze.repayments": [
        "repayment_id", "transaction_id", "user_id", "installment_number", "amount", "due_date", "status",
        "created_at", "updated_at", "_ingested_at",
    ],
    "bronze.installments": [
        "schedule_id", "transaction_id", "user_id", "total_amount", "installment_count", "installment_amount",
        "start_date", "end_date", "status", "created_at", "_ingested_at",
    ],
}

RESULT_SCHEMA = (
    "check_time timestamp_ntz, stage string, check_name string, check_type string, status string, "
    "details string, rows_checked bigint, rows_failed bigint"
)
AUDIT_SCHEMA = (
    "event_time timestamp_ntz, dag_id string, task_id string, run_id string, status string, "
    "duration_seconds double, details string"
)
