"""Declared column lists and types per layer.

Raw sources are all-string header CSVs; the bronze layer adds three string
audit columns.  Silver and gold layers are projected explicitly by the jobs,
so their column order is stated here once.
"""

from pyspark.sql.types import StringType, StructField, StructType

# The raw column lists of every landed source, in file order.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "full_name", "email", "phone", "city", "state",
        "kyc_tier", "wallet_limit", "customer_segment", "created_date",
    ],
    "merchants": [
        "merchant_id", "merchant_name", "category", "sub_category", "city",
        "state", "is_active", "onboarded_date",
    ],
    "payment_methods": [
        "method_id", "method_code", "method_name", "method_type", "is_active",
    ],
    "transactions": [
        "transaction_id", "customer_id", "merchant_id", "method_code",
        "txn_date", "txn_amount", "platform_fee", "cashback_amount",
        "txn_status", "failure_reason", "is_fraud_flag",
    ],
    "customer_updates": [
        "customer_id", "full_name", "email", "phone", "city", "state",
        "kyc_tier", "wallet_limit", "customer_segment", "created_date",
        "updated_date",
    ],
}

# Bronze table name of every source.
BRONZE_TABLES: dict[str, str] = {
    "customers": "raw_customers",
    "merchants": "raw_merchants",
    "payment_methods": "raw_payment_methods",
    "transactions": "raw_transactions",
    "customer_updates": "raw_customer_updates",
}

AUDIT_COLUMNS = ["load_timestamp", "source_file", "load_date"]


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def raw_schema(source: str) -> StructType:
    return string_schema(RAW_COLUMNS[source])


def bronze_schema(source: str) -> StructType:
    return string_schema(RAW_COLUMNS[source] + AUDIT_COLUMNS)


# Silver column order per table (audit columns are carried through).
SILVER_COLUMNS: dict[str, list[str]] = {
    "customers": RAW_COLUMNS["customers"] + ["is_active"] + AUDIT_COLUMNS + ["silver_loaded_at"],
    "merchants": RAW_COLUMNS["merchants"] + AUDIT_COLUMNS + ["silver_loaded_at"],
    "payment_methods": RAW_COLUMNS["payment_methods"] + AUDIT_COLUMNS + ["silver_loaded_at"],
    "transactions": RAW_COLUMNS["transactions"]
    + ["net_revenue", "txn_year", "txn_month"]
    + AUDIT_COLUMNS
    + ["silver_loaded_at"],
}

# Tracked attributes (their order enters the record hash) and the
# column lists of the star schema.  A change of a customer's opens a new version.
CUSTOMER_TRACKED = ["kyc_tier", "wallet_limit", "customer_segment", "city", "state"]
MERCHANT_TRACKED = ["merchant_name", "category", "sub_category", "city", "state", "is_active"]
PAYMENT_TRACKED = ["method_name", "method_type", "is_active"]

DIM_MERCHANT_COLUMNS = [
    "merchant_key", "merchant_id", "merchant_name", "category", "sub_category",
    "city", "state", "is_active", "onboarded_date", "record_hash", "updated_at",
]
DIM_PAYMENT_COLUMNS = [
    "payment_method_key", "method_id", "method_code", "method_name",
    "method_type", "is_active", "record_hash", "updated_at",
]
DIM_CUSTOMER_COLUMNS = [
    "customer_key", "customer_id", "full_name", "email", "phone", "city",
    "state", "kyc_tier", "wallet_limit", "customer_segment", "created_date",
    "is_active", "record_hash", "effective_start", "effective_end",
    "is_current",
]
FACT_COLUMNS = [
    "customer_key", "merchant_key", "payment_method_key", "date_key",
    "transaction_id", "txn_date", "txn_status", "failure_reason",
    "method_code", "txn_amount", "platform_fee", "cashback_amount",
    "net_revenue", "is_fraud_flag", "txn_year", "txn_month", "created_at",
]
