"""Schemas, fixed constants and the ``conform`` step.

Every operator in the package sees one typed schema.  Columns that are absent
from a source are added as typed NULLs by :func:`conform`, so the "column is
missing" defaults of the scoring rules become "value is NULL" defaults that
are expressed once, as column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names of a raw transfer.
# --------------------------------------------------------------------------
SEQ = "seq"
CUSTOMER = "CustomerId"
ACCOUNT = "FromAccountNo"
BENEFICIARY = "ReceipentAccount"  # spelling kept: it is the input column name
AMOUNT = "AmountInAed"
TRANSFER_TYPE = "TransferType"
CHANNEL = "ChannelId"
COUNTRY = "BankCountry"
CREATED = "CreateDate"

ACCOUNT_KEY = (CUSTOMER, ACCOUNT)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(SEQ, T.LongType()),
        T.StructField(CUSTOMER, T.StringType()),
        T.StructField(ACCOUNT, T.StringType()),
        T.StructField(BENEFICIARY, T.StringType()),
        T.StructField(AMOUNT, T.DoubleType()),
        T.StructField(TRANSFER_TYPE, T.StringType()),
        T.StructField(CHANNEL, T.StringType()),
        T.StructField(COUNTRY, T.StringType()),
        T.StructField(CREATED, T.TimestampType()),
    ]
)

# Decision log (one row per decided transfer).
LOG_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Timestamp", T.TimestampType()),
    ]
)

# --------------------------------------------------------------------------
# Fixed values.  These must equal the scoring rules being reproduced; they are
# listed here plainly, together, in their natural order.
# --------------------------------------------------------------------------
# Transfer type code -> display name
TRANSFER_TYPE_NAME = {"S": "Overseas", "I": "Ajman", "L": "UAE", "Q": "Quick", "O": "Own"}
# Transfer type code -> model encoding (unknown or NULL: 0)
TRANSFER_TYPE_ENCODED = {"S": 4, "I": 1, "L": 2, "Q": 3, "O": 0}
TYPE_ENCODED_DEFAULT = 0
# Transfer type code -> risk weight (unknown or NULL: 0.5)
TRANSFER_TYPE_RISK = {"S": 0.9, "I": 0.1, "L": 0.2, "Q": 0.5, "O": 0.0}
TYPE_RISK_DEFAULT = 0.5
# Dynamic limit: max(avg + multiplier * std, floor); unknown type: 3.0 and 2000
TRANSFER_MULTIPLIERS = {"S": 2.0, "Q": 2.5, "L": 3.0, "I": 3.5, "O": 4.0}
TRANSFER_MIN_FLOORS = {"S": 5000, "Q": 3000, "L": 2000, "I": 1500, "O": 1000}
MULTIPLIER_DEFAULT = 3.0
FLOOR_DEFAULT = 2000
# Order in which all limits of an account are listed
LIMIT_TYPE_ORDER = ["S", "I", "L", "Q", "O"]
# Velocity limits (count in window must not exceed)
MAX_VELOCITY_10MIN = 5
MAX_VELOCITY_1HOUR = 15
# Trailing-window widths in seconds
WINDOW_30S = 30
WINDOW_10MIN = 600
WINDOW_1HOUR = 3600
WINDOW_30D = 30 * 24 * 3600
BURST_SECONDS = 300
DEFAULT_GAP_SECONDS = 3600.0
NIGHT_BEFORE_HOUR = 6
NIGHT_FROM_HOUR = 22
NULL_HOUR = 12
NULL_DAY_OF_WEEK = 0
# Serving defaults of an account without history: avg, std, max
NO_HISTORY_PROFILE = (5000.0, 2000.0, 15000.0)
# Std used for the decision when the account has exactly one row
ONE_ROW_DECISION_STD = 2000.0
# Anomaly models
IFOREST_TREES = 100
IFOREST_CONTAMINATION = 0.05
IFOREST_SEED = 42
IFOREST_MAX_SAMPLES = 256
AE_HIDDEN = [64, 32]
AE_MIN_BOTTLENECK = 7
AE_K = 3.0
AE_INVALID_ERROR = 999.0
# Decision-log statuses; only the first two change account state
STATUS_APPROVED = "Approved"
STATUS_FORCE_APPROVED = "Force Approved"
STATUS_REJECTED = "Rejected"

# Model feature list, in model order (43 entries).
MODEL_FEATURES = [
    "transaction_amount", "flag_amount", "transfer_type_encoded", "transfer_type_risk",
    "channel_encoded", "deviation_from_avg", "amount_to_max_ratio", "rolling_std",
    "transaction_velocity", "weekly_total", "weekly_txn_count", "weekly_avg_amount",
    "weekly_deviation", "amount_vs_weekly_avg", "current_month_spending", "monthly_txn_count",
    "monthly_avg_amount", "monthly_deviation", "amount_vs_monthly_avg", "hourly_total",
    "hourly_count", "daily_total", "daily_count", "hour", "day_of_week", "is_weekend",
    "is_night", "time_since_last", "recent_burst", "txn_count_30s", "txn_count_10min",
    "txn_count_1hour", "user_avg_amount", "user_std_amount", "user_max_amount",
    "user_txn_frequency", "intl_ratio", "user_high_risk_txn_ratio",
    "user_multiple_accounts_flag", "cross_account_transfer_ratio",
    "geo_anomaly_flag", "is_new_beneficiary", "beneficiary_txn_count_30d",
]

# Integer-valued features (counts bigint, flags and codes int); the rest double.
COUNT_FEATURES = {
    "weekly_txn_count", "monthly_txn_count", "hourly_count", "daily_count",
    "txn_count_30s", "txn_count_10min", "txn_count_1hour", "user_txn_frequency",
    "beneficiary_txn_count_30d",
}
FLAG_FEATURES = {
    "flag_amount", "transfer_type_encoded", "channel_encoded", "hour", "day_of_week",
    "is_weekend", "is_night", "recent_burst", "user_multiple_accounts_flag",
    "geo_anomaly_flag", "is_new_beneficiary",
}


def map_literal(mapping: dict) -> Column:
    """A MapType literal built from a Python dict (kept in insertion order)."""
    parts = []
    for k, v in mapping.items():
        parts.extend([F.lit(k), F.lit(v)])
    return F.create_map(*parts)


KEY_COLUMNS = (CUSTOMER, ACCOUNT, BENEFICIARY)


def _is_key_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.IntegerType, T.LongType, T.ShortType))


def conform(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed NULLs.

    Key columns (customer, account, beneficiary) keep their source type when it
    is a string or an integer, since they are only compared for equality.
    Amounts that arrive as text are coerced with ``try_cast`` (bad text ->
    NULL) and dates that arrive as text with ``try_to_timestamp``.  Extra
    columns are kept after the schema columns.
    """
    present = set(df.columns)
    cols = []
    for field in schema.fields:
        name = field.name
        if name not in present:
            cols.append(F.lit(None).cast(field.dataType).alias(name))
            continue
        src = df.schema[name].dataType
        if src == field.dataType or (name in KEY_COLUMNS and _is_key_type(src)):
            cols.append(F.col(name))
        elif isinstance(field.dataType, T.TimestampType) and isinstance(src, T.StringType):
            cols.append(F.try_to_timestamp(F.col(name)).alias(name))
        elif isinstance(field.dataType, T.TimestampType):
            cols.append(F.col(name).try_cast(T.TimestampType()).alias(name))
        elif isinstance(field.dataType, T.StringType):
            cols.append(F.col(name).cast(T.StringType()).alias(name))
        else:
            cols.append(F.col(name).try_cast(field.dataType).alias(name))
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)
