"""Declared schemas of the two input tables, and the column names the operators default to."""

from pyspark.sql import types as T

# Column names and types of the transaction table.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_long", T.DoubleType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("time_since_last", T.DoubleType()),
        T.StructField("foreign_country", T.IntegerType()),
        T.StructField("multiple_quick_trans", T.IntegerType()),
    ]
)

# The profile columns that give a customer a home location.
PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("home_lat", T.DoubleType()),
        T.StructField("home_long", T.DoubleType()),
    ]
)

LABEL = "is_fraud"
ID = "transaction_id"
TIME = "timestamp"
CUSTOMER = "customer_id"
