"""Table schemas and the fixed values the feature definitions depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: word lists, formats, patterns and constants of the feature definitions ---
HIGH_RISK_FORMATS = ["Bitcoin", "Wire", "Cash"]
TXN_TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm"
BANK_NAME_PATTERN = r"^.+ Bank #[0-9]+$"
BANK_COUNTRY_PATTERN = r"^(.*) Bank #[0-9]+$"
ENTITY_SUFFIX_PATTERN = r"\s*#[0-9]+$"
COUNTRY_TYPO = ("CRYTPO", "CRYPTO")
DEFAULT_COUNTRY = "US"
PATTERN_BEGIN = "BEGIN LAUNDERING ATTEMPT"
PATTERN_END = "END LAUNDERING ATTEMPT"
PATTERN_TYPE_PATTERN = r"-\s*([A-Za-z\- ]+?)(?::|$)"
PATTERN_TYPE_UNKNOWN = "UNKNOWN"
PATTERN_MIN_FIELDS = 11
TAIL_CUTOFF_DATE = "2022-09-11"
TRAIN_FRACTION = 0.60
VAL_FRACTION = 0.20
TRAIN_NEGATIVES = 400_000
EXPECTED_MIN_TRANSACTIONS = 5_000_000
EXPECTED_MIN_ACCOUNTS = 500_000
REQUEST_FEATURES = [
    "amount_paid",
    "is_cross_currency",
    "is_cross_border",
    "is_high_risk_format",
    "amount_to_avg_ratio",
]
PROFILE_FEATURES = [
    "hist_txn_count",
    "hist_avg_amount",
    "hist_std_amount",
    "hist_max_amount",
    "hist_distinct_receivers",
    "hist_distinct_receiver_banks",
    "hist_distinct_countries",
    "hist_foreign_ccy_share",
    "hist_high_risk_share",
]
RISK_FEATURES = ["hist_amount_cv", "hist_receiver_fanout"]
MONOTONE_FEATURES = [
    "amount_paid",
    "is_cross_currency",
    "is_cross_border",
    "is_high_risk_format",
    "amount_to_avg_ratio",
    "hist_receiver_fanout",
]
ONE_HOT_PREFIX = "payment_format_"
RECALL_FRACTION = 0.01
# --- end of fixed values ---

TXN_SCHEMA = T.StructType(
    [
        T.StructField("txn_timestamp", T.StringType()),
        T.StructField("from_bank", T.StringType()),
        T.StructField("from_account", T.StringType()),
        T.StructField("to_bank", T.StringType()),
        T.StructField("to_account", T.StringType()),
        T.StructField("amount_received", T.DoubleType()),
        T.StructField("receiving_currency", T.StringType()),
        T.StructField("amount_paid", T.DoubleType()),
        T.StructField("payment_currency", T.StringType()),
        T.StructField("payment_format", T.StringType()),
        T.StructField("is_laundering", T.IntegerType()),
    ]
)

ACCOUNT_SCHEMA = T.StructType(
    [
        T.StructField("bank_name", T.StringType()),
        T.StructField("bank_id", T.StringType()),
        T.StructField("account_number", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_name", T.StringType()),
    ]
)

# Event-time watermarks need TIMESTAMP, so the stream edge does not use TIMESTAMP_NTZ.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("amount_paid", T.DoubleType()),
        T.StructField("receiver_account_id", T.StringType()),
        T.StructField("receiver_bank", T.StringType()),
        T.StructField("is_cross_currency", T.LongType()),
        T.StructField("is_high_risk_format", T.LongType()),
    ]
)
