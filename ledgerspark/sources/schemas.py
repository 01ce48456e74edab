"""Declared schemas and fixed domain values.

Schemas are declared, never inferred. Note that the file sources make every field nullable
whatever the declaration says, so not-null is a rule, not a schema property.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---- fixed values (must equal the source system's) --------------------------------------
OPEN_END = _dt.date(9999, 12, 31)                 # open end of a validity window, never NULL
OPEN_END_TS = _dt.datetime(9999, 12, 31, 0, 0, 0)  # same sentinel for snapshot stamps
CURRENCY_PATTERN = "^[A-Z]{3}$"
SSN_PATTERN = "^[0-9]{4}$"
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
OFFSET_TIMESTAMP_PATTERN = "(Z|[+-][0-9]{2}:[0-9]{2})$"
ACCEPTED_CURRENCIES = ("USD", "EUR", "GBP", "CAD", "AUD")
ACCEPTED_STATUSES = ("active", "suspended", "frozen", "closed")
HIGH_VALUE_THRESHOLD = 10000
LATE_INGESTION_SECONDS = 7200
# ------------------------------------------------------------------------------------------

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("account_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("ssn_last4", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("transaction_type", T.StringType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("ingestion_timestamp", T.TimestampType(), False),
])

ACCOUNT_STATE_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType(), False),
    T.StructField("account_status", T.StringType(), False),
    T.StructField("credit_limit", T.IntegerType(), False),
    T.StructField("effective_date", T.DateType(), False),
])

TRANSACTION_KEY = "transaction_id"
ACCOUNT_KEYS = ("account_id",)
ACCOUNT_TRACKED = ("account_status", "credit_limit")
BATCH_COL = "_batch"
REASON_COL = "rejection_reason"
