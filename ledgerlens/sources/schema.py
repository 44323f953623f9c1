"""Declared schemas of the three ledger inputs (no type inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: the system account.  As a source it marks a bonus, as a
# target a penalty.
SYSTEM_ID = -1

LABELS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("inactive", T.IntegerType(), True),
])

POPULATION = T.StructType([
    T.StructField("id", T.LongType(), False),
])

USERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("start_balance", T.DoubleType(), True),
    T.StructField("registration_time", T.TimestampNTZType(), True),
    T.StructField("account_type", T.StringType(), True),
    T.StructField("business_type", T.StringType(), True),
    T.StructField("area_name", T.StringType(), True),
    T.StructField("area_type", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
])

TRANSACTIONS = T.StructType([
    T.StructField("source", T.LongType(), False),
    T.StructField("target", T.LongType(), False),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("amount", T.DecimalType(18, 2), True),
])

# The profile columns that are categorical (one-hot candidates, in the
# order whose last writer wins when two columns share a value).
ONEHOT_COLUMNS = ["business_type", "area_name", "area_type", "gender"]
STRING_COLUMNS = ["account_type", "business_type", "area_name", "area_type", "gender"]
